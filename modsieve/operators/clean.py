"""Order-stable deduplication and text washing."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modsieve.functions.repair import repair_decoding
from modsieve.functions.text import SPACE
from modsieve.keys import digests

# Replacement marks of the washing step.
URL_MARK, EMAIL_MARK, PHONE_MARK = "<URL>", "<EMAIL>", "<PHONE>"
# Patterns of the washing step, valid in Java and RE2.
WASH_URL = r"(?:https?|ftp)://[^" + SPACE + r"""<>"']+|\bwww\.[A-Za-z0-9\-]+\.[^""" + SPACE + r"""<>"']+"""
WASH_EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}"
WASH_PHONE = r"(?:\+?[0-9]{1,3}[ .\-])?\(?[0-9]{3}\)?[ .\-][0-9]{3}[ .\-][0-9]{4}\b"
PHONE_HINT = r"[0-9]{3}[ .\-][0-9]{4}"
WASH_EMOJI = r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B00}-\x{2BFF}\x{FE0F}\x{200D}\x{20E3}]"


def dedupe(df: DataFrame, keys: Sequence[str] | None, order_by: Sequence[str]) -> DataFrame:
    """First row per key tuple by ``order_by``; without usable keys, distinct whole rows.

    The whole row rides in a minimum, which is combined before the shuffle: copies
    of one text collapse where they are read. Groups are told apart by digests, so
    long texts are neither sorted nor compared.
    """
    if not keys or any(k not in df.columns for k in keys):
        return df.distinct()
    order = list(order_by)
    first = F.min(F.struct(*order, *[c for c in df.columns if c not in order])).alias("first")
    return df.groupBy(*digests(df, keys)).agg(first).select(*[F.col("first")[c].alias(c) for c in df.columns])


def _replace_where(col: Column, hint: Column, pattern: str, mark: str) -> Column:
    """Run the pattern only on texts that pass a cheap, necessary test."""
    return F.when(hint, F.regexp_replace(col, pattern, mark)).otherwise(col)


def wash_patterns(col: Column) -> Column:
    """URLs, e-mail addresses and phone numbers become marks; emoji go.

    The marks hold none of the characters that the later tests look for, so every
    test may look at the original text.
    """
    washed = _replace_where(col, col.contains("://") | col.contains("www."), WASH_URL, URL_MARK)
    washed = _replace_where(washed, col.contains("@"), WASH_EMAIL, EMAIL_MARK)
    washed = _replace_where(washed, col.rlike(PHONE_HINT), WASH_PHONE, PHONE_MARK)
    return _replace_where(washed, F.octet_length(col) > F.char_length(col), WASH_EMOJI, "")


# Typographic marks and Latin letters that have no decomposition.
ASCII_FORMS = {
    "\u2018": "'", "\u2019": "'", "\u201a": "'", "\u201b": "'", "\u201c": '"', "\u201d": '"', "\u201e": '"', "\u201f": '"',
    "\u00ab": '"', "\u00bb": '"', "\u2039": "'", "\u203a": "'", "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-",
    "\u2014": "-", "\u2015": "-", "\u2212": "-", "\u00df": "ss", "\u1e9e": "SS", "\u00e6": "ae", "\u00c6": "AE", "\u0153": "oe",
    "\u0152": "OE", "\u00f8": "o", "\u00d8": "O", "\u0142": "l", "\u0141": "L", "\u0111": "d", "\u0110": "D", "\u00f0": "d",
    "\u00d0": "D", "\u00fe": "th", "\u00de": "Th", "\u0131": "i", "\u0127": "h", "\u0126": "H",
}


def fold_to_ascii(col: Column) -> Column:
    """ASCII form of every letter that has one; all others stay as they are.

    Quotes and dashes are straightened, letters lose their marks, compatibility forms are
    spelled out. Nothing is deleted. No built-in function normalises text, hence one Arrow
    step; the function is local so that it travels to the workers by value.
    """
    forms = dict(ASCII_FORMS)

    def fold(texts: pd.Series) -> pd.Series:
        def letter(c):
            if c not in forms:
                plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
                forms[c] = plain if plain and plain.isascii() else c
            return forms[c]

        def one(text):
            if text.isascii():
                return text
            return "".join(c if c.isascii() else letter(c) for c in unicodedata.normalize("NFC", text))

        return texts.map(one, na_action="ignore")

    return F.pandas_udf(fold, T.StringType())(col)


def wash_text(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    dedupe_on: Sequence[str] | None = None,
    order_by: Sequence[str] = ("row_id",),
    to_ascii: bool = True,
    repair: bool = True,
) -> DataFrame:
    """Wash every text column (or ``columns``), then deduplicate if keys are given.

    Wrongly decoded text is repaired first, see ``repair_decoding``.
    """
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    # All folds run in one Python step, the patterns after it in one native projection.
    sound = df.withColumns({c: repair_decoding(F.col(c)) for c in names}) if repair else df
    folded = sound.withColumns({c: fold_to_ascii(F.col(c)) for c in names}) if to_ascii else sound
    out = folded.withColumns({c: wash_patterns(F.col(c)) for c in names})
    return dedupe(out, dedupe_on, order_by) if dedupe_on else out


def not_ascii(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per text column, the rows that hold letters without an ASCII form (after folding)."""
    counts = [F.struct(F.lit(c).alias("column"), F.count_if(F.octet_length(c) > F.char_length(c)).alias("n_rows")) for c in columns]
    return df.agg(F.array(*counts).alias("r")).select(F.inline("r"))


def redundancy_gate(tables: DataFrame, report: DataFrame, features: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """All datasets, deduplicated: on the features where the report counts duplicates, else on whole rows.

    Both tables carry ``dataset``; a dataset without a report counts as not flagged. The
    report has a row for each dataset, so it is broadcast.
    """
    flags = report.groupBy("dataset").agg(F.max(F.col("n_duplicates") > 0).alias("__flag"))
    marked = tables.join(F.broadcast(flags), "dataset", "left").select(*tables.columns, F.coalesce("__flag", F.lit(False)).alias("__flag"))
    flagged = dedupe(marked.filter("__flag").drop("__flag"), ["dataset", *features], order_by)
    return flagged.unionByName(marked.filter("not __flag").drop("__flag").distinct())

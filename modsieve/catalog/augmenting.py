"""Queries: text augmentation."""

from __future__ import annotations

from pyspark.sql import functions as F

from modsieve.catalog.fixtures import lexicon, linked, reviews, texts, with_tables
from modsieve.catalog.folding import md5_of
from modsieve.catalog.registry import query
from modsieve.functions.text import BAD_HOST, SPACE, URL_ANYWHERE, URL_BEFORE_PATH, URL_DOMAIN, URL_TO_CLEAN
from modsieve.operators import augment as A

SEED = 1234
KEY = ["row_id"]


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def uniform_sql(hashed: str) -> str:
    return f"(('0x' || substr({hashed}, 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def rewrite_sql(body: str, pattern: str, rewrite) -> str:
    """The text cut at the matches, with the matches rewritten."""
    found = f"list_transform(regexp_extract_all({body}, {quoted(pattern)}), lambda u: {rewrite('u')})"
    pieces = f"string_split_regex({body}, {quoted(pattern)})"
    return f"array_to_string(list_transform(list_zip({pieces}, {found}), lambda z: z[1] || coalesce(z[2], '')), '')"


def short_url_sql(u: str) -> str:
    rest = f"regexp_replace({u}, '^https?://', '')"
    host = f"regexp_extract({rest}, '^[^/?#]*')"
    domain = f"regexp_replace(lower({host}), '^www\\.', '')"
    path = f"regexp_replace(regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1), ';[^/]*$', '')"
    first_two = f"array_to_string(list_filter(string_split({path}, '/'), lambda p: p <> '')[1:2], '/')"
    return f"""CASE WHEN regexp_matches({host}, {quoted(BAD_HOST)}) THEN '<url>: (unknown)'
        ELSE '<url>: (' || {domain} || CASE WHEN {first_two} <> '' THEN '/' || {first_two} ELSE '' END || ')' END"""


def url_words_sql(u: str) -> str:
    low = f"lower({u})"
    labels = f"list_filter(string_split(regexp_extract({low}, {quoted(URL_DOMAIN)}, 1), '.'), lambda p: p <> '')"
    parts = f"list_filter(string_split_regex(regexp_replace({low}, {quoted(URL_BEFORE_PATH)}, ''), '[/_.-]+'), lambda p: regexp_full_match(p, '[\\p{{L}}\\p{{N}}]+'))"
    return f"""trim(array_to_string(list_transform({labels}, lambda p: 'domain:' || p || ' '), '')
        || array_to_string(list_transform({parts}, lambda p: 'path:' || p), ''), ' ')"""


CLEANED = rewrite_sql("body", URL_TO_CLEAN, short_url_sql)
SEMANTIC = rewrite_sql("body", URL_ANYWHERE, url_words_sql)


@query("url_clean", with_tables("linked", "", f"SELECT row_id, {CLEANED} AS body FROM linked"))
def _(spark, sf):
    return A.url_clean(linked(spark, sf).select("row_id", "body"), "body")


@query("url_semantics", with_tables("linked", "", f"SELECT row_id, {SEMANTIC} AS body FROM linked"))
def _(spark, sf):
    return A.url_semantics(linked(spark, sf).select("row_id", "body"), "body")


BANK = f"""found AS (SELECT row_id, regexp_extract_all(body, {quoted(URL_ANYWHERE)}) AS urls FROM linked),
bank AS (SELECT row_id, unnest(range(len(urls)))::INTEGER AS slot, unnest(urls) AS url FROM found)"""


@query("url_bank", with_tables("linked", BANK, "SELECT row_id, slot, url FROM bank"))
def _(spark, sf):
    return A.url_bank(linked(spark, sf), "body", KEY)


def draws_sql(source: str, most: int, op: str, key: str = "row_id") -> str:
    """Steps ``d1``..: draw ``i`` is uniform below ``total - k + i``; a repeat takes the top place."""
    steps = []
    for i in range(1, most + 1):
        drawn = f"floor({uniform_sql(md5_of(op, f'{key}, {i}'))} * (total - k + {i}))::BIGINT"
        taken = " OR ".join(f"{drawn} = p{j}" for j in range(1, i)) or "false"
        steps.append(
            f"d{i} AS (SELECT *, CASE WHEN {taken} THEN total - k + {i} - 1 ELSE {drawn} END AS p{i} FROM {source if i == 1 else f'd{i - 1}'})"
        )
    flat = " UNION ALL ".join(
        f"SELECT {key}, {i} AS i, p{i} AS place FROM d{most} WHERE k >= {i} AND k <= total" for i in range(1, most + 1)
    )
    return ",\n".join([*steps, f"flat AS ({flat})"])


@query(
    "append_random_urls",
    with_tables(
        "linked",
        BANK
        + f""", cards AS (SELECT url, row_number() OVER (ORDER BY {md5_of('bank', 'row_id, slot')}, row_id, slot) - 1 AS place FROM bank),
        d0 AS (SELECT row_id, (SELECT count(*) FROM bank) AS total, 1 + floor({uniform_sql(md5_of('urls'))} * 5)::BIGINT AS k FROM linked),
        {draws_sql('d0', 5, 'url')},
        tails AS (SELECT row_id, string_agg(url, ' ' ORDER BY i) AS tail FROM flat JOIN cards USING (place) GROUP BY row_id)""",
        "SELECT row_id, body || coalesce(' ' || tail, '') AS body FROM linked LEFT JOIN tails USING (row_id)",
    ),
)
def _(spark, sf):
    base = linked(spark, sf).select("row_id", "body")
    return A.append_random_urls(base, "body", A.url_bank(base, "body", KEY), SEED, KEY)


def shuffled_sql(parts: str, op: str, key: str = "row_id") -> str:
    ranked = f"list_transform({parts}, lambda p, i: {{'h': {md5_of(op, f'{key}, i - 1')}, 'i': i - 1, 'p': p}})"
    return f"list_transform(list_sort({ranked}), lambda r: r.p)"


SENTENCES = f"array_to_string({shuffled_sql(f'string_split_regex(body, {quoted(f'(?:\\.[{SPACE}]|\\n)+')})', 'sentence')}, '. ')"


@query("sentence_shuffle", with_tables("texts", "", f"SELECT row_id, {SENTENCES} AS body FROM texts"))
def _(spark, sf):
    return A.sentence_shuffle(texts(spark, sf).select("row_id", "body"), "body", SEED, KEY)


SPLIT_WORDS = f"string_split_regex(body, {quoted(f'[{SPACE}]+')})"


@query(
    "append_random_words",
    with_tables(
        "texts",
        f"""w AS (SELECT row_id, body, {SPLIT_WORDS} AS words FROM texts),
        d0 AS (SELECT row_id, len(words) AS total, least(len(words), 5 + floor({uniform_sql(md5_of('words'))} * 10)::BIGINT) AS k FROM w),
        {draws_sql('d0', 14, 'word')},
        tails AS (SELECT row_id, string_agg(words[place + 1], ' ' ORDER BY {md5_of('word order', 'row_id, place')}, place) AS tail
                  FROM flat JOIN w USING (row_id) GROUP BY row_id)""",
        "SELECT row_id, body || tail AS body FROM texts JOIN tails USING (row_id)",
    ),
)
def _(spark, sf):
    return A.append_random_words(texts(spark, sf).select("row_id", "body"), "body", SEED, KEY)


@query(
    "phonetic_swap",
    with_tables(
        "texts lexicon",
        f"""w AS (SELECT row_id, {SPLIT_WORDS} AS words FROM texts),
        d0 AS (SELECT row_id, len(words) AS total,
                      least(3, len(words)) + floor({uniform_sql(md5_of('swaps'))} * (least(10, len(words)) - least(3, len(words)) + 1))::BIGINT AS k FROM w),
        {draws_sql('d0', 10, 'swap')},
        words_of AS (SELECT row_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM w),
        swapped AS (SELECT r.row_id, r.place, CASE WHEN f.place IS NOT NULL AND length(r.word) <= 10 AND phones IS NOT NULL
                       THEN lower(regexp_replace(phones, '[{SPACE}\\p{{Nd}}]', '', 'g')) ELSE r.word END AS word
                    FROM words_of r LEFT JOIN flat f ON f.row_id = r.row_id AND f.place = r.place
                    LEFT JOIN lexicon l ON l.word = lower(r.word))""",
        "SELECT row_id, string_agg(word, ' ' ORDER BY place) AS body FROM swapped GROUP BY row_id",
    ),
)
def _(spark, sf):
    return A.phonetic_swap(texts(spark, sf).select("row_id", "body"), "body", lexicon(spark, sf), SEED, KEY)


@query(
    "rule_flip",
    f"""SELECT doc_id AS row_id, regexp_replace('Do not spam, no ads. ' || text, {quoted(A.NEGATION)}, '', 'g') AS rule,
               CAST(1 - toxic AS INTEGER) AS rule_violation, 1 AS flip FROM documents JOIN labels USING (doc_id)""",
)
def _(spark, sf):
    ruled = reviews(spark, sf).select(
        "row_id", F.concat(F.lit("Do not spam, no ads. "), "body").alias("rule"), "rule_violation", F.lit(0).alias("flip")
    )
    return A.rule_flip(ruled)


@query(
    "apply_with_probability",
    with_tables(
        "linked",
        "",
        f"""SELECT row_id, CASE WHEN {uniform_sql(md5_of('apply url_to_semantics'))} < 0.4::DOUBLE THEN {SEMANTIC} ELSE body END AS body FROM linked""",
    ),
)
def _(spark, sf):
    return A.apply_with_probability(linked(spark, sf).select("row_id", "body"), "url_to_semantics", 40, A.Context(SEED))


@query(
    "augment_random_url_after_cleaning",
    with_tables("linked", "", "SELECT count(*) * 2 AS n_rows, count(*) AS n_appended, true AS known FROM linked"),
)
def _(spark, sf):
    """After the texts' own URLs are gone, the appended ones still come from the table as given."""
    base = linked(spark, sf).select("row_id", F.lit("r").alias("rule"), F.concat_ws(" ", "row_id", "body").alias("body"))
    out = A.augment(base, [("url_cleaner", 1.0), ("random_url", 1.0)], A.Context(SEED))
    bank = A.url_bank(base, "body", KEY).select("url").distinct().withColumn("__known", F.lit(True))
    found = A.url_bank(out.filter("copy = 1"), "body", KEY).join(bank, "url", "left")
    found = found.groupBy("row_id").agg(F.bool_and(F.coalesce("__known", F.lit(False))).alias("known"))
    counts = found.agg(F.count(F.lit(1)).alias("n_appended"), F.bool_and("known").alias("known"))
    rows = out.agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.withColumns({c: counts.select(c).scalar() for c in ("n_appended", "known")})


@query(
    "augment",
    with_tables(
        "linked",
        f"""copies AS (SELECT row_id, rule, rule_violation, body, copy::INTEGER AS copy FROM linked, range(1, 4) r(copy)),
        step1 AS (SELECT * REPLACE (CASE WHEN {uniform_sql(md5_of('apply url_to_semantics', 'row_id, copy'))} < 0.7::DOUBLE THEN {SEMANTIC} ELSE body END AS body) FROM copies),
        step2 AS (SELECT * REPLACE ({SENTENCES.replace("'sentence', row_id,", "'sentence', row_id, copy,")} AS body) FROM step1),
        placed AS (SELECT *, row_number() OVER (PARTITION BY copy ORDER BY {md5_of('resample', 'row_id, copy')}, row_id) AS pos,
                          count(*) OVER (PARTITION BY copy) AS n FROM step2),
        stacked AS (SELECT row_id, rule, rule_violation, body, 0 AS copy, 1.0::DOUBLE AS weight FROM linked
                    UNION ALL SELECT row_id, rule, rule_violation, body, copy, 0.9::DOUBLE / 3 FROM placed WHERE pos <= round(n * 0.5::DOUBLE)),
        firsts AS (SELECT *, row_number() OVER (PARTITION BY rule, body ORDER BY copy, row_id) AS rn FROM stacked)""",
        "SELECT row_id, rule, rule_violation, body, copy, weight FROM firsts WHERE rn = 1",
    ),
)
def _(spark, sf):
    base = linked(spark, sf).withColumn("weight", F.lit(1.0))
    return A.augment(
        base, [("url_to_semantics", 0.7), ("sentence_shuffle", 1.0)], A.Context(SEED), frac=0.5, resample=3, weight=0.9, tta=True
    )

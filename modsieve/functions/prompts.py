"""Prompt columns: pair text, few-shot and zero-shot prompts, chat messages, completions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from modsieve.functions.text import strip, word_count, words
from modsieve.spec import COLUMNS

# Prompt texts and answers.
SEPARATOR = "[SEP]"
POSITIVE_ANSWER = "YES"
NEGATIVE_ANSWER = "NO"
COMPLETION_PHRASE = "Violation"
POSITIVE_COMPLETION = " Yes"
NEGATIVE_COMPLETION = " No"
TASK = (
    "You are given a comment from reddit and a rule. Your task is classify if it violates the given rule. "
    "Only respond YES or NO."
)
CHAT_TASK = (
    "You are given a comment on reddit. Your task is to classify if it violates the given rule. "
    "Only respond YES or NO."
)

# A plain stand-in for a model's own chat template.
MESSAGE_TEMPLATE = ("<", ">\n", "\n")
ANSWER_TURN = "<assistant>\n"


def pair_prompt() -> Column:
    """Rule and body around a separator; null if either is."""
    return F.concat(F.col(COLUMNS.rule), F.lit(SEPARATOR), F.col(COLUMNS.body))


def _examples() -> list[tuple[Column, str]]:
    """Positive and negative examples in turn, with their answers."""
    shown = []
    for positive, negative in zip(COLUMNS.positive_examples, COLUMNS.negative_examples):
        shown += [(F.col(positive), POSITIVE_ANSWER), (F.col(negative), NEGATIVE_ANSWER)]
    return shown


def few_shot_prompt() -> Column:
    """Task, community, rule, four answered examples and the open question."""
    parts = [F.lit(f"\n{TASK}\n\nr/"), F.col(COLUMNS.community), F.lit("\nRule: "), F.col(COLUMNS.rule)]
    for number, (text, answer) in enumerate(_examples(), 1):
        parts += [F.lit(f"\n\n{number}) "), text, F.lit(f"\n{COMPLETION_PHRASE}: {answer}")]
    parts += [F.lit(f"\n\n{len(_examples()) + 1}) "), F.col(COLUMNS.body), F.lit(f"\n{COMPLETION_PHRASE}: ")]
    return F.concat(*parts)


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def few_shot_messages() -> Column:
    rule = strip(F.col(COLUMNS.rule))
    turns = [_message("system", strip(F.concat(F.lit(CHAT_TASK + "\nRule : "), rule)))]
    for text, answer in _examples():
        turns += [_message("user", strip(text)), _message("assistant", F.lit(answer))]
    return F.array(*turns, _message("user", strip(F.col(COLUMNS.body))))


def zero_shot_messages() -> Column:
    rule = strip(F.col(COLUMNS.rule))
    return F.array(
        _message("system", F.concat(F.lit(TASK + "Rule : "), rule)),
        _message("user", strip(F.col(COLUMNS.body))),
    )


def render_messages(messages: Column, template: tuple[str, str, str] = MESSAGE_TEMPLATE, answer: str = ANSWER_TURN) -> Column:
    """Messages as one text; ``template`` goes before the role, after it, and after the content.

    Null if any content is null: joining the turns as an array would drop them silently.
    """
    before, between, after = (F.lit(t) for t in template)
    return F.aggregate(
        messages,
        F.lit(""),
        lambda text, m: F.concat(text, before, m["role"], between, m["content"], after),
        lambda text: F.concat(text, F.lit(answer)),
    )


def zero_shot_prompt(**template) -> Column:
    return F.concat(render_messages(zero_shot_messages(), **template), F.lit(f"{COMPLETION_PHRASE}:"))


def completion_text(prompt: Column, label: Column) -> Column:
    answer = F.when(label == 1, POSITIVE_COMPLETION).when(label == 0, NEGATIVE_COMPLETION)
    return F.concat(prompt, answer)


def is_longer(text: Column, max_words: int) -> Column:
    return word_count(text) > max_words


def truncate(text: Column, max_words: int) -> Column:
    """At most the first ``max_words`` words; shorter texts stay as they are."""
    head = F.array_join(F.slice(words(text), 1, max_words), " ")
    return F.when(is_longer(text, max_words), head).otherwise(text)

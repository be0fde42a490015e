"""Quality rules as a short-circuit cascade, ordered by rejections per cost; no Python on the data path.

A rule is a condition that rejects a text.  Some need only the measures that the result
has anyway; the others read the text again.  On a sample the cascade counts how many texts
each rule rejects and times how long it takes to tell; rules then run in the order of
rejections per time, as the branches of one CASE expression.  Its branches are evaluated
one after the other, so a text leaves at its first failing rule and costs nothing in those
behind it.  The order changes the work, never the verdict.
"""

from __future__ import annotations

import re
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memberpulse.llm.common import Workspace

WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"


#: Times that the sample's rows are told by a rule while it is timed, and runs of which the fastest counts.
REPEATS, RUNS = 4, 2
#: Seconds that a rule over the measures alone is taken to cost on the sample.
LEAST_COST = 1e-4


@dataclass(frozen=True)
class Rule:
    """``rejects``: SQL condition over the measures and the text ``t`` (never NULL)."""

    name: str
    rejects: str


#: The base rules: too short, or more than half of the words in repeated three-word windows.
BASE = (
    Rule("short", "n_words < 50"),
    Rule("repetition", "100 * n_repeat_words > 50 * n_words"),
)
# Words without a letter; lines that begin with a bullet; lines that end in an ellipsis.
NO_LETTER = r"(?<![^\x20\x09-\x0D])[^A-Za-z\x80-\x{10FFFF}\x20\x09-\x0D]++(?![^\x20\x09-\x0D])"
BULLET = r"(?m)^[\x20\x09\x0B-\x0D]*+[*+\u2022\u2023\u25AA-][\x20\x09]"
ELLIPSIS = r"(?m)(?:\.\.\.|\u2026)[\x20\x09\x0B-\x0D]*+$"
#: The cascade's further rules; the last three read the text again.
FURTHER = (
    Rule("word_length_low", "word_chars < 2 * n_words"),
    Rule("word_length_high", "word_chars > 14 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "n_lines >= 3 AND 100 * n_dup_lines > 50 * n_lines"),
    Rule("words_without_letters", f"100 * regexp_count(t, r'{NO_LETTER}') > 30 * n_words"),
    Rule("bullet_lines", f"n_lines >= 3 AND 100 * regexp_count(t, r'{BULLET}') > 90 * n_lines"),
    Rule("ellipsis_lines", f"n_lines >= 3 AND 100 * regexp_count(t, r'{ELLIPSIS}') > 30 * n_lines"),
)


def words(text: Column) -> Column:
    """Runs without ASCII white space; NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def _shift(kind: str, value: Column, bits: Column) -> Column:
    return F.call_function(kind, value, bits)


def _repeated(docs: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words in three-word windows found twice or more, from the columns ``w`` and ``n_words``.

    Windows are sorted as one 64-bit number each: the window's hash above, its position
    below (as many bits as the text needs).  Neighbours with equal hash bits are compared
    word by word, so a shared hash alone never counts.
    """
    # all of a text's work is on primitive arrays: one sort, then passes over neighbours
    bits = F.greatest(F.lit(1), F.ceil(F.log2(F.col("n_words") + 1))).cast("int")
    hashes = F.transform(F.slice("w", 1, F.greatest(F.lit(0), F.size("w") - 2)), lambda x, i: _shift(
        "shiftleft", F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)), F.col("bits")).bitwiseOR(i.cast("long")))
    at = lambda i: F.get("s", i)
    place = lambda x: x.bitwiseAND(_shift("shiftleft", F.lit(1).cast("long"), F.col("bits")) - 1).cast("int")

    def same(x: Column, y: Column) -> Column:
        equal = _shift("shiftrightunsigned", x, F.col("bits")) == _shift("shiftrightunsigned", y, F.col("bits"))
        for k in range(3):
            equal = equal & (F.get("w", place(x) + k) == F.get("w", place(y) + k))
        return F.coalesce(equal, F.lit(False))

    repeated = F.filter("s", lambda x, i: same(x, at(i - 1)) | same(x, at(i + 1)))
    positions = F.sort_array(F.transform(repeated, place))
    step = F.transform("p", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("p", i + 1) - x, F.lit(3))))
    total = F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)
    return (docs.withColumn("bits", bits).withColumn("s", F.sort_array(hashes)).withColumn("p", positions)
            .withColumn("n_repeat_words", total).drop("bits", "s", "p"))


def measures(docs: DataFrame, text_col: str = "text", keep: str = "row") -> DataFrame:
    """``keep`` (a struct of the row), the text ``t`` and the measures of every text.

    ``n_chars``, ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_lines``
    (lines with a word), ``n_dup_lines`` (of these, equal to an earlier one), ``n_repeat_words``.
    """
    base = docs.select(F.struct("*").alias(keep), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    base = base.select(keep, "t", words(F.col("t")).alias("w"), F.filter(
        F.split("t", "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0).alias("lines"))
    base = base.withColumn("n_words", F.size("w").cast("long"))
    out = _repeated(base)
    return out.select(
        keep, "t", F.length("t").cast("long").alias("n_chars"), "n_words", F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), "n_repeat_words")


def rule_order(docs: DataFrame, rules: Sequence[Rule], text_col: str = "text", sample_rows: int = 2000) -> list[Rule]:
    """Rules by falling rejections per second on about ``sample_rows`` texts (chosen by text hash).

    The measured sample is staged.  One job counts the rejections of all rules; then each
    rule that reads the text is timed in a job of its own, less the time of a job without a
    rule.  Rules over the measures alone cost next to nothing.  The sample sets the order
    only.  Ties and an empty sample: by time, then as given.
    """
    ws = Workspace(docs.sparkSession)
    n = docs.count()
    share = min(1.0, sample_rows / n) if n else 1.0
    chosen = docs.where(F.pmod(F.xxhash64(text_col), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = ws.stage("sample", measures(chosen, text_col, "row").drop("row"))
    rejected = sample.agg(*[F.count_if(F.expr(r.rejects)).alias(str(i)) for i, r in enumerate(rules)]).first()
    rows = sample.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))

    def seconds(rejects: str) -> float:
        taken = []
        for _ in range(RUNS):
            begin = time.perf_counter()
            rows.agg(F.count_if(F.expr(rejects)), F.max(F.octet_length("t"))).first()
            taken.append(time.perf_counter() - begin)
        return min(taken)

    reading = [r for r in rules if re.search(r"\bt\b", r.rejects)]
    idle = seconds("false") if reading else 0.0
    cost = {r.name: max(LEAST_COST, seconds(r.rejects) - idle) if r in reading else LEAST_COST for r in rules}
    gain = {r.name: rejected[i] / cost[r.name] for i, r in enumerate(rules)}
    ws.drop("sample")
    return sorted(rules, key=lambda r: (-gain[r.name], cost[r.name]))


def cascade(docs: DataFrame, rules: tuple[Rule, ...] = FURTHER, base: tuple[Rule, ...] = BASE, text_col: str = "text",
            sample_rows: int = 2000, order: Sequence[Rule] | None = None) -> DataFrame:
    """``row`` (all columns of ``docs``), the measures, ``base_failed``, ``failed_rule`` and ``kept``.

    ``failed_rule``: the first rule in cascade order that rejects the text, NULL for kept
    ones; rules behind it are not evaluated for that text.  ``order``: the rules in an order
    of the caller's (no sample is taken then).  NULL and empty texts have no word and fail
    as short.  Repeated rows are judged alike; ``docs`` may have any other columns.
    """
    order = rule_order(docs, base + rules, text_col, sample_rows) if order is None else order
    measured = measures(docs, text_col)
    verdict = F.lit(None).cast("string")
    for rule in reversed(order):
        verdict = F.when(F.expr(rule.rejects), rule.name).otherwise(verdict)
    failed = F.expr(" OR ".join(f"({r.rejects})" for r in base))
    judged = measured.select("*", failed.alias("base_failed"), verdict.alias("failed_rule"))
    return judged.select("*", F.col("failed_rule").isNull().alias("kept")).drop("t")

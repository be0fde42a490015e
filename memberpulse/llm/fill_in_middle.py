"""Fill-in-middle transformation: one counted-quantifier match cuts a document; no Python on the data path.

``regexp_count`` gives a text's number of units.  Two places among them are drawn from a
hash of the id, and a pattern made for that row, with possessive counted groups
``((?:unit){a}+)((?:unit){b - a}+)(.*)``, captures prefix, middle and suffix in one match
that also writes them in their new order.  Possessive groups never step back, so the match
is one pass over the text and needs no stack, whatever its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A run of ASCII letters or any other code point.
UNIT = "[A-Za-z]++|[^A-Za-z]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARK = "<[PSM]>"


def draws(doc_id: Column, seed: str) -> list[Column]:
    """The first four 8-digit groups of the hex SHA-256 of ``seed:id``, as unsigned integers; a NULL id is empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def fill_in_middle(docs: DataFrame, seed: str = "1", plain_percent: int = 10, spm_percent: int = 20, unit: str = UNIT,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``), ``n``, ``form``, ``output``, ``prefix_chars`` and ``middle_chars``.

    ``n``: units of the text.  ``form``: ``psm`` (prefix, suffix, middle after their marks),
    ``spm`` (suffix first; about ``spm_percent`` of the cut texts) or ``plain`` (the text as
    it is; about ``plain_percent`` of all).  Empty and NULL texts (no units, empty output)
    and texts that hold a mark are plain.  Both lengths count code points and are NULL if
    plain.  The draws depend on seed and id alone, so repeated rows are cut alike and equal
    ids are drawn alike; NULL ids are drawn as one id.  Texts of any length are cut whole.
    """
    h1, h2, h3, h4 = draws(F.col(id_col), seed)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    held = docs.select(F.struct("*").alias("row"), text.alias("t"), F.regexp_count(text, F.lit(unit)).cast("bigint").alias("n"),
                       h1.alias("h1"), h2.alias("h2"), h3.alias("h3"), h4.alias("h4"))
    one, other = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    plain = (F.col("t") == "") | F.col("t").rlike(MARK) | (F.col("h3") % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    placed = held.select("row", "t", "n", form.alias("form"), F.least(one, other).alias("a"), F.greatest(one, other).alias("b"))
    pattern = F.format_string(rf"(?s)\A((?:{unit.replace('%', '%%')}){{%d}}+)((?:{unit.replace('%', '%%')}){{%d}}+)(.*)\z",
                              F.col("a"), F.col("b") - F.col("a"))
    order = F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    output = F.when(F.col("form") == "plain", F.col("t")).otherwise(F.regexp_replace("t", pattern, order))
    parts = cut_parts(F.col("output"), F.col("form"))
    return (placed.select("row", "n", "form", output.alias("output")).select("*", parts.alias("parts"))
            .select("row", "n", "form", "output", F.length("parts.prefix").cast("bigint").alias("prefix_chars"),
                    F.length("parts.middle").cast("bigint").alias("middle_chars")))


def cut_parts(output: Column, form: Column) -> Column:
    """``(prefix, middle, suffix)`` read back from an output; NULL if plain.

    Unambiguous: a text with a mark is plain, and no two marks can overlap.
    """
    found = F.split(output, MARK)
    first, second, third = (F.get(found, i) for i in (1, 2, 3))
    cut = F.struct(F.when(form == "psm", first).otherwise(second).alias("prefix"), third.alias("middle"),
                   F.when(form == "psm", second).otherwise(first).alias("suffix"))
    return F.when(form != "plain", cut)


def restore(transformed: DataFrame, restored_col: str = "restored") -> DataFrame:
    """Adds the original text, rebuilt from ``output`` and ``form`` alone (a NULL text comes back empty)."""
    parts = cut_parts(F.col("output"), F.col("form"))
    return transformed.select("*", parts.alias("cut_parts")).select(
        *transformed.columns, F.when(F.col("form") == "plain", F.col("output")).otherwise(
            F.concat("cut_parts.prefix", "cut_parts.middle", "cut_parts.suffix")).alias(restored_col))

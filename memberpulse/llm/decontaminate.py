"""Benchmark decontamination as a prefix-filtered set join over word shingles; no Python on the data path.

A benchmark item's windows (``window`` consecutive words, or the whole item if shorter)
are sets of shingles, all of which a document must hold to hold the window.  A first pass
over the documents counts the benchmark's shingles and orders them by rarity.  Since
containment must be full, a prefix of one shingle per window, the rarest, is necessary and
enough: only these are joined with the documents' words.  Their offset places the window in
the document (positional bound), places where it would not fit are dropped (length bound),
and the words there are compared with the window's own.

The benchmark is the query set: it is taken in blocks of bounded size, so that a block can
be broadcast whatever the benchmark's size, and no word of a document is ever shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memberpulse.llm.common import Workspace, row_key

#: Between words; A-Z stand in words here, as they are lower-cased or only counted.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: About as many shingles (a hash and a length) or windows (some 13 words) of the benchmark are broadcast at once.
BLOCK_SHINGLES = 200_000


def words(text: Column) -> Column:
    """Words of a text after lower-casing A-Z; NULL has none."""
    ascii_only = F.octet_length(text) == F.length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return _split(low)


def _split(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def benchmark_windows(items: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(win, size, item)``: distinct windows of every item with a word, by their joined words."""
    size = F.least(F.lit(window), F.col("n"))
    return (items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w"))
            .select("item", "w", F.size("w").alias("n")).where("n > 0 AND item IS NOT NULL")
            .select("item", "w", size.alias("size"), F.explode(F.sequence(F.lit(0), F.col("n") - size)).alias("i"))
            .select(F.array_join(F.slice("w", F.col("i") + 1, F.col("size")), " ").alias("win"), "size", "item")
            .distinct())


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """``(win, size, off, len, h)``: every shingle of every distinct window, by its offset."""
    length = F.least(F.lit(shingle), F.col("size"))
    w = windows.select("win", "size").distinct().select("win", "size", F.split("win", " ").alias("w"), length.alias("len"))
    w = w.select("win", "size", "w", "len", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("len"))).alias("off"))
    hashes = F.coalesce(*[F.when(F.col("len") == n, _hash("w", F.col("off"), n)) for n in range(1, shingle + 1)])
    return w.select("win", "size", "off", "len", hashes.alias("h"))


def _hash(array: str, place: Column, length: int) -> Column:
    return F.xxhash64(F.lit(length), *[F.get(array, place + i) for i in range(length)])


def _placed(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """``(.., w, n, p, len, h)``: the hash of every run of each length at every place of the documents' words.

    A document without words has one row without a place, a run beyond its end no hash.
    """
    # the outer form only keeps Spark from inferring a filter that would cut every text twice
    rows = docs.withColumn("w", words(F.col("text"))).drop("text").withColumn("n", F.size("w"))
    rows = rows.select("*", F.posexplode_outer("w").alias("p", "first")).drop("first")
    runs = [F.struct(F.lit(n).alias("len"), F.when(F.col("p") + n <= F.col("n"), _hash("w", F.col("p"), n)).alias("h")) for n in lengths]
    run = runs[0] if len(runs) == 1 else F.explode(F.array(*runs))
    return rows.select("*", run.alias("run")).select(*rows.columns, "run.len", "run.h")


def rarity(docs: DataFrame, shingles: DataFrame, lengths: list[int], ws: Workspace, name: str) -> tuple[DataFrame, DataFrame]:
    """``(h, df)``, how often each of the ``shingles`` occurs in all documents, and the documents ``(id, key, n)``.

    One pass: places of a benchmark shingle, and the first place of every document, leave it.
    """
    targets = F.broadcast(shingles.select("len", "h").distinct().withColumn("known", F.lit(True)))
    rows = _placed(docs, lengths).join(targets, ["len", "h"], "left")
    first = (F.col("len") == lengths[0]) & (F.coalesce("p", F.lit(0)) == 0)
    seen = ws.stage(name, rows.where(F.col("known") | first).select(
        F.when(first, F.struct("id", "key", "n")).alias("doc"), F.when(F.col("known"), F.col("h")).alias("h")))
    return seen.where("h IS NOT NULL").groupBy("h").agg(F.count("*").alias("df")), seen.where("doc IS NOT NULL").select("doc.*")


def held_windows(docs: DataFrame, shingles: DataFrame, counted: DataFrame, lengths: list[int]) -> DataFrame:
    """``(key, win, start, size)``: every place of the ``shingles``' windows in the documents.

    Only a window's rarest shingle is joined; a window with a shingle that occurs nowhere can't occur.
    """
    ranked = shingles.join(counted, "h", "left").groupBy("win", "size", "len").agg(
        F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "off", "h")).alias("rarest"))
    prefix = F.broadcast(ranked.where("rarest.df > 0").select("win", "size", "len", "rarest.off", "rarest.h"))
    rows = _placed(docs.select("key", "text"), lengths).join(prefix, ["len", "h"])
    start = F.col("p") - F.col("off")
    fits = rows.select("key", "w", "n", "win", "size", start.alias("start")).where("start >= 0 AND start + size <= n")
    same = F.array_join(F.slice("w", F.col("start") + 1, F.col("size")), " ") == F.col("win")
    return fits.where(same).select("key", "win", "start", "size")


def contaminated_words(docs: DataFrame, items: DataFrame, ws: Workspace, window: int = 13, shingle: int = 5,
                       item_id: str = "item_id", item_text: str = "text", block: int = BLOCK_SHINGLES) -> tuple[DataFrame, DataFrame] | None:
    """``(key, n_hit, n_items, items_sha256)`` of the documents ``(id, key, text)`` that hold a window, and all ``(id, key, n)``.

    None: no item.
    """
    windows = ws.stage("windows", benchmark_windows(items, window, item_id, item_text))
    shingles = ws.stage("shingles", window_shingles(windows, shingle))
    total = shingles.count()
    if not total:
        return None
    lengths = sorted(r["len"] for r in shingles.select("len").distinct().collect())          # at most the shingle size
    blocks, parts, base = -(-total // block), [], None
    for number in range(blocks):
        mine = ws.stage(f"block_{number}", shingles.where(F.pmod(F.xxhash64("win"), F.lit(blocks)) == number))
        counted, seen = rarity(docs, mine, lengths, ws, f"seen_{number}")
        base = seen if base is None else base
        parts.append(ws.stage(f"held_{number}", held_windows(docs, mine, counted, lengths)))
        ws.drop(f"block_{number}", *([f"seen_{number}"] if number else []))
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.union(part)
    spans = F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("stop"))))
    covered = F.aggregate("spans", F.struct(F.lit(0).alias("stop"), F.lit(0).cast("long").alias("n")), lambda a, s: F.struct(
        F.greatest(a["stop"], s["stop"]).alias("stop"),
        (a["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(a["stop"], s["start"]))).alias("n")))["n"]
    n_hit = hits.groupBy("key").agg(spans.alias("spans")).select("key", covered.alias("n_hit"))
    held = hits.select("key", "win").distinct().join(windows.select("win", "item"), "win").groupBy("key").agg(
        F.sort_array(F.collect_set("item")).alias("items"))
    held = held.select("key", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    result = ws.stage("contaminated", n_hit.join(held, "key"))
    ws.drop("windows", "shingles", *[f"held_{n}" for n in range(blocks)])
    return result, base


def decontamination_report(docs: DataFrame, items: DataFrame, window: int = 13, shingle: int = 5, ratio: int = 20,
                           id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                           item_text: str = "text", block: int = BLOCK_SHINGLES) -> DataFrame:
    """Per document: ``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, key)``.

    A word inside any occurrence of an item window is hit; contaminated: some word is hit
    and ``ratio * n_hit >= n_words``.  NULL or wordless texts have zero counts and the hash
    of the empty list.  Items without a word or without an id have no windows; equal item
    ids count once.  Documents are told apart by id and text, so repeated rows get the same
    result and a repeated or NULL id with another text its own.  Other columns are ignored.
    ``block``: shingles of the benchmark that are searched at once.
    """
    ws = Workspace(docs.sparkSession)
    keyed = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    found = contaminated_words(keyed, items, ws, window, shingle, item_id, item_text, block)
    zero = F.lit(0).cast("long")
    if found is None:
        base = keyed.select("id", "key", F.size(_split(F.col("text"))).alias("n"), zero.alias("n_hit"), zero.alias("n_items"),
                            F.lit(None).cast("string").alias("items_sha256"))
    else:
        base = found[1].join(found[0], "key", "left")
    n_hit, n_words = F.coalesce("n_hit", zero), F.col("n").cast("long")
    return base.select(
        F.col("id").alias(id_col), n_words.alias("n_words"), n_hit.alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((n_hit > 0) & (ratio * n_hit >= n_words)).alias("contaminated"), "key")


def clean_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all their columns, that are not contaminated."""
    report = decontamination_report(docs, items, id_col=id_col, text_col=text_col, **options)
    bad = report.where("contaminated").select("key").distinct()
    whole = docs.select(F.struct("*").alias("row"), row_key(id_col, text_col).alias("key"))
    return whole.join(bad, "key", "left_anti").select("row.*")

"""Benchmark contamination by winnowing, in DataFrame functions only.

A window is a run of ``window`` words of a benchmark item, or the whole item if
it has fewer. For windows of m words, k-grams of k = (m + 1) // 2 words are
hashed; the fingerprint of a window is the smallest hash of its m - k + 1
k-grams. Equal windows have equal fingerprints, so every shared span of m words
is found. Neighbouring windows of a document mostly have one fingerprint: such
a run of windows is one row, about two rows for seven words.

1. Fingerprints of the documents' windows are joined with those of the
   benchmark's. Most documents end here.
2. Hits are extended: the windows of each run that was hit are joined with the
   benchmark's windows, word for word. Hash collisions cost work, no result.
3. Windows with the same items form a class. Documents with the same classes
   share one list of items, which is put together once, so a passage that all
   items and a third of all documents hold makes no pairs of them.

Joins are equi-joins. Written tables of the benchmark are broadcast by the
optimizer where they are small, else shuffled; adaptive execution splits hot
keys. Texts are shuffled once, to meet their hits in step 2.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countlake.session import write_through

WINDOW = 10

#: Fixed value: what separates words once A-Z are in lower case, as a Java pattern.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text; null has none."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.length(text)  # ASCII only, where lower() is quicker
    small = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(small, SEPARATORS), "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _spread(values: Column, width: int, combine: Callable[[Column, Column], Column]) -> Column:
    """``combine`` over every run of ``width`` neighbouring values, in the order of their starts.

    Takes logarithmically many steps over the array; combining overlapping parts
    must do no harm. What stands after the last whole run has no meaning.
    """

    def joined(values: Column, step: int) -> Column:
        return _let(
            values,
            lambda held: F.transform(held, lambda x, i: combine(x, F.get(held, i + step))),
        )

    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        values = joined(values, step)
        reach += step
    return values


def _fingerprints(hashes: Column, m: int) -> Column:
    """Fingerprint of every window of ``m`` words, from the hashes of the words."""
    k = (m + 1) // 2
    grams = _spread(hashes, k, lambda a, b: F.xxhash64(F.lit(m), a, b))
    least = _spread(grams, m - k + 1, lambda a, b: F.least(a, b))
    return F.slice(least, F.lit(1), F.greatest(F.size(hashes) - (m - 1), F.lit(0)))


def _runs(prints: Column, m: int) -> Column:
    """Runs of windows with one fingerprint: structs of m, print, first and last window."""

    def heads(held: Column) -> Column:
        marked = F.transform(
            held,
            lambda x, i: F.when(
                F.coalesce(x != F.get(held, i - 1), F.lit(True)),
                F.struct(x.alias("print"), (i + 1).alias("first")),
            ),
        )
        return F.filter(marked, lambda x: x.isNotNull())

    def closed(held: Column) -> Column:
        return F.transform(
            held,
            lambda x, i: F.struct(
                F.lit(m).alias("m"),
                x["print"].alias("print"),
                x["first"].alias("first"),
                F.coalesce(F.get(held, i + 1)["first"] - 1, F.size(prints)).alias("last"),
            ),
        )

    return _let(_let(prints, heads), closed)


def _identity(key: str, text: str) -> Column:
    """Tells a document from others by 128 bits of its key and text."""
    parts = [F.col(key).isNull(), F.col(key), F.coalesce(F.col(text), F.lit(""))]
    return F.struct(F.xxhash64(F.lit(1), *parts).alias("a"), F.xxhash64(F.lit(2), *parts[::-1]).alias("b"))


def benchmark_windows(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """(m, phrase, print, items, class): every distinct window with the items that hold it."""
    rows = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), words(F.col(text)).alias("words")
    ).where(F.size("words") > 0)
    phrases = (
        rows.withColumn("m", F.least(F.size("words"), F.lit(window)))
        .withColumn("start", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("m") + 1)))
        .select("item", "m", F.array_join(F.slice("words", F.col("start"), F.col("m")), " ").alias("phrase"))
        .distinct()
    )
    held = write_through(
        phrases.groupBy("m", "phrase")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
        .withColumn("class", F.sha2(F.to_json("items"), 256)),
        "benchmark-windows",
    )
    hashes = F.transform(F.split("phrase", " "), lambda w: F.xxhash64(w))
    found = F.lit(None).cast("long")
    for m in range(1, window + 1):
        found = F.when(F.col("m") == m, _fingerprints(hashes, m)[0]).otherwise(found)
    return write_through(held.withColumn("print", found), "benchmark-prints")


def _covered(spans: Column) -> Column:
    """Number of words in the union of spans (first, last)."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach"))

    def add(held: Column, span: Column) -> Column:
        new = F.greatest(span["last"] - F.greatest(span["first"] - 1, held["reach"]), F.lit(0))
        return F.struct(
            (held["n"] + new.cast("long")).alias("n"), F.greatest(held["reach"], span["last"]).alias("reach")
        )

    return F.aggregate(F.array_sort(spans), start, add, lambda held: held["n"])


def _marked(docs: DataFrame, key: str, text: str, lengths: list[int]) -> DataFrame:
    """(key, id, n_words, marks): the runs of windows of all lengths in every document."""
    split = docs.select(
        F.col(key).alias("key"), _identity(key, text).alias("id"), words(F.col(text)).alias("words")
    )
    hashed = split.select(
        "key",
        "id",
        F.size("words").cast("long").alias("n_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    prints = hashed.select(
        "key", "id", "n_words", *[_fingerprints(F.col("hashes"), m).alias(f"p{m}") for m in lengths]
    )
    runs = [F.when(F.size(f"p{m}") > 0, _runs(F.col(f"p{m}"), m)).otherwise(F.array()) for m in lengths]
    nothing = F.array().cast("array<struct<m:int,print:bigint,first:int,last:int>>")
    return prints.select("key", "id", "n_words", F.concat(nothing, *runs).alias("marks"))


def hits(docs: DataFrame, marks: DataFrame, windows: DataFrame, key: str, text: str) -> DataFrame:
    """(id, spans, classes) of the documents that hold windows: where, and of which classes."""
    prints = write_through(windows.select("m", "print").distinct(), "prints")
    runs = (
        marks.select("id", F.explode("marks").alias("mark"))
        .select("id", "mark.*")
        .join(prints, ["m", "print"])
        .select("id", "m", "first", "last")
        .distinct()  # rows repeated whole are one
    )
    hit = write_through(
        runs.groupBy("id").agg(F.collect_list(F.struct("m", "first", "last")).alias("runs")), "print-hits"
    )
    # Hits grow with the documents: both sides are shuffled at any size, never broadcast.
    texts = docs.select(_identity(key, text).alias("id"), F.col(text).alias("text")).hint("shuffle_merge")
    placed = (
        texts.join(hit, "id")
        .dropDuplicates(["id"])
        .select("id", words(F.col("text")).alias("words"), "runs")
        .select("id", "words", F.explode("runs").alias("run"))
        .select("id", "words", "run.m", F.explode(F.sequence("run.first", "run.last")).alias("first"))
    )
    phrase = F.array_join(F.slice("words", F.col("first"), F.col("m")), " ")
    found = placed.select("id", "m", "first", phrase.alias("phrase")).join(
        windows.select("m", "phrase", "class"), ["m", "phrase"]
    )
    last = (F.col("first") + F.col("m") - 1).alias("last")
    return write_through(
        found.groupBy("id").agg(
            F.collect_set(F.struct("first", last)).alias("spans"),
            F.array_sort(F.collect_set("class")).alias("classes"),
        ),
        "window-hits",
    )


def _item_lists(found: DataFrame, windows: DataFrame) -> DataFrame:
    """(classes, n_items, items): the items of every set of classes that a document holds."""
    of_class = windows.groupBy("class").agg(F.any_value("items").alias("items"))
    return (
        found.select("classes")
        .distinct()
        .withColumn("class", F.explode("classes"))
        .join(of_class, "class")
        .select("classes", F.explode("items").alias("item"))
        .distinct()
        .groupBy("classes")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
        .select("classes", F.size("items").cast("long").alias("n_items"), "items")
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_hit, spans, n_items, items, contaminated.

    ``spans`` are the windows found, as numbers of their first and last word
    from 1 on, and null without any; ``items`` are the ids of the items whose
    windows occur, sorted as strings. Null and empty texts have no words, and
    items without words no windows. A null item id counts as an empty one;
    items with one id are one item. Repeated rows are judged alike. An empty
    benchmark hits nothing; an empty table gives an empty result. Other columns
    are not looked at.
    """
    windows = benchmark_windows(benchmark, item, item_text, window)
    lengths = [r.m for r in windows.select("m").distinct().orderBy("m").collect()]  # at most ``window``
    marks = write_through(_marked(docs, key, text, lengths), "fingerprints")
    found = hits(docs, marks, windows, key, text)
    lists = write_through(_item_lists(found, windows), "item-lists")
    judged = found.join(lists, "classes").select(
        "id", _covered(F.col("spans")).alias("n_hit"), "spans", "n_items", "items"
    )
    return (
        marks.select("key", "id", "n_words")
        .join(judged, "id", "left")
        .select(
            F.col("key").alias(key),
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            "spans",
            F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        )
    )

"""Benchmark decontamination by winnowing; DataFrame expressions only.

A window is WINDOW words in a row, or all words of an item that has fewer. Strings of up to
GRAM words are hashed, and of as many neighbouring hashes as fit into a window the least is
kept. Equal windows keep equal hashes, so every shared window leaves a shared fingerprint:
nothing is missed, whatever its place.

1. Items and documents are reduced to their fingerprints; those of documents that items
   have as well name the texts to look at. Equal texts are looked at once.
2. In these, every place whose kept hash is an item's is a hit. It is extended to the whole
   window, which is held against the windows of the items by 128 bits.
3. Overlapping windows are united by a running maximum of their ends. Windows with the same
   items form a class, and texts with the same classes share one list of items, so that a
   passage held by many texts and many items does not make all pairs of them.

Null texts and texts without words have no windows and are clean, as is everything where no
item has words. Rows of documents are judged one by one, equal ones alike, whatever their
ids. Items with one id count once; one with a null id hits words, but is not listed. A very
long text takes memory in proportion to its words. Columns of other names play no part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.llm.tables import table, written

#: Words of a window, and of the strings that are hashed.
WINDOW, GRAM = 10, 5
NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TEXT = ["text_a", "text_b"]
PLACE = ["window_a", "window_b"]


def word_hashes(text: Column) -> Column:
    """A hash per word; A-Z count as a-z, other letters as they are."""

    def hashed(word: Column) -> Column:
        plain = F.octet_length(word) == F.char_length(word)
        return F.xxhash64(F.when(plain, F.lower(word)).otherwise(F.translate(word, UPPER, LOWERED)))

    # Splitting takes a ninth of the time of extracting; it may leave an empty string at both ends.
    return F.transform(F.array_remove(F.split(F.coalesce(text, F.lit("")), NO_WORD), ""), hashed)


def per_place(words: str, size: int, value: Callable[[Column], Column]) -> Column:
    """An array of a value for every place (from 0) from which the array has `size` elements."""
    places = F.sequence(F.lit(0), F.size(words) - size)
    return F.when(F.size(words) >= size, F.transform(places, value)).otherwise(F.array().cast("array<long>"))


def of_elements(words: str, size: int, combined: Callable[..., Column]) -> Callable[[Column], Column]:
    """The value of `size` neighbouring elements, from a place on."""
    return lambda place: combined(*(F.get(words, place + i) for i in range(size)))


def kept_hashes(rows: DataFrame, words: str, window: int, name: str) -> DataFrame:
    """The rows with the kept hash of each window of so many words as an array column."""
    gram = min(GRAM, window)
    hashed = of_elements(words, gram, lambda *parts: F.xxhash64(F.lit(window), *parts))
    rows = rows.withColumn(name, per_place(words, gram, hashed))
    if window > gram:
        rows = rows.withColumn(name, per_place(name, window - gram + 1, of_elements(name, window - gram + 1, F.least)))
    return rows


def with_kept(rows: DataFrame, windows: list[int]) -> DataFrame:
    for window in windows:
        rows = kept_hashes(rows, "words", window, f"kept_{window}")
    return rows


def windows_of(rows: DataFrame, keys: list[str], windows: list[int]) -> DataFrame:
    """The keys, start, end, fingerprint and 128-bit hash of each window; rows have `words`."""
    rows = with_kept(rows, windows)
    parts = []
    for window in windows:
        for name, salt in zip(PLACE, (17, 91)):
            whole = of_elements("words", window, lambda *parts, salt=salt: F.xxhash64(F.lit(salt), F.lit(window), *parts))
            rows = rows.withColumn(f"{name}_{window}", per_place("words", window, whole))
        arrays = F.arrays_zip(*(F.col(f"{c}_{window}").alias(c) for c in ("kept", *PLACE)))
        placed = rows.select(*keys, F.posexplode(arrays).alias("start", "found"))
        parts.append(placed.select(*keys, "start", (F.col("start") + window).alias("end"), F.col("found.kept").alias("kept"), *(F.col(f"found.{c}").alias(c) for c in PLACE)))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole


def item_windows(benchmark: DataFrame) -> tuple[DataFrame, list[int]]:
    """item_id and windows of all items with words, and which sizes of windows there are."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), word_hashes(F.col("text")).alias("words"))
    items = written(items.where(F.size("words") > 0), "items")
    size = F.least(F.size("words"), F.lit(WINDOW))
    sizes = sorted(r[0] for r in items.select(size.alias("size")).distinct().collect()) or [WINDOW]
    # An item of fewer words than a window has the one of its own size only.
    placed = windows_of(items.withColumn("size", size), ["item_id", "size"], sizes)
    return placed.where(F.col("end") - F.col("start") == F.col("size")).drop("start", "end", "size"), sizes


def set_hash(*columns: str) -> list[Column]:
    """Two hashes of a set of distinct rows that do not depend on their order."""
    return [F.bit_xor(F.xxhash64(F.lit(salt), *columns)) for salt in (3, 58)]


def fingerprints(documents: DataFrame, sizes: list[int]) -> DataFrame:
    """doc_id, digests of the text, number of words and distinct kept hashes, as written."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_a"),
        F.xxhash64(F.lit("second"), text).alias("text_b"),
        word_hashes(F.col("text")).alias("words"),
    )
    kept = F.array_distinct(F.concat(*(F.col(f"kept_{size}") for size in sizes)))
    rows = with_kept(rows, sizes).select("doc_id", *TEXT, F.size("words").cast("long").alias("n_words"), kept.alias("kept"))
    return written(rows, "fingerprints")


def texts_of_hits(documents: DataFrame, named: DataFrame) -> DataFrame:
    """Digests and word hashes of the named texts, each once."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(F.xxhash64(text).alias("text_a"), F.xxhash64(F.lit("second"), text).alias("text_b"), "text")
    once = rows.join(named, TEXT, "left_semi").groupBy(*TEXT).agg(F.first("text").alias("text"))
    return written(once.select(*TEXT, word_hashes(F.col("text")).alias("words")), "candidates")


def hit_words(hits: DataFrame) -> DataFrame:
    """How many words of each text the windows cover, overlaps counted once."""
    before = Window.partitionBy(*TEXT).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest(F.coalesce(F.max("end").over(before), F.lit(0)), "start")
    fresh = hits.select(*TEXT, "start", "end").withColumn("fresh", F.greatest(F.col("end") - reached, F.lit(0)))
    return fresh.groupBy(*TEXT).agg(F.sum("fresh").cast("long").alias("n_hit"))


def hit_items(hits: DataFrame, items: DataFrame) -> DataFrame:
    """Number of items and digest of their sorted ids for each text."""
    pairs = items.where("item_id is not null").select("item_id", *PLACE).distinct()
    classes = written(pairs.groupBy(*PLACE).agg(*(c.alias(n) for c, n in zip(set_hash("item_id"), ("class_a", "class_b")))), "classes")
    class_items = pairs.join(classes, PLACE).select("class_a", "class_b", "item_id").distinct()
    of_text = written(hits.select(*TEXT, *PLACE).distinct().join(classes, PLACE).select(*TEXT, "class_a", "class_b").distinct(), "text_classes")
    lists = of_text.groupBy(*TEXT).agg(*(c.alias(n) for c, n in zip(set_hash("class_a", "class_b"), ("list_a", "list_b"))))
    lists = written(lists, "lists")
    one = lists.groupBy("list_a", "list_b").agg(F.min(F.struct(*TEXT)).alias("one")).select("list_a", "list_b", "one.*")
    listed = one.join(of_text, TEXT).join(class_items, ["class_a", "class_b"]).select("list_a", "list_b", "item_id").distinct()
    ids = F.array_sort(F.collect_list("item_id"))
    digests = listed.groupBy("list_a", "list_b").agg(F.count("*").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"))
    return lists.join(digests, ["list_a", "list_b"]).select(*TEXT, "n_items", "items_sha256")


def contaminated_spans(documents: DataFrame, items: DataFrame, kept: DataFrame, sizes: list[int]) -> DataFrame:
    """Windows of items in the texts: digests of the text, start, end and the window's hash."""
    marks = written(items.select("kept").distinct(), "marks")
    named = kept.select(*TEXT, F.explode("kept").alias("kept")).join(marks, "kept", "left_semi").select(*TEXT).distinct()
    texts = texts_of_hits(documents, written(named, "named"))
    hits = windows_of(texts, TEXT, sizes).join(marks, "kept", "left_semi")
    return written(hits.join(items.select(*PLACE).distinct(), PLACE, "left_semi").drop("kept"), "hits")


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every row."""
    items, sizes = item_windows(benchmark)
    items = written(items, "item_windows")
    kept = fingerprints(documents, sizes)
    hits = contaminated_spans(documents, items, kept, sizes)
    found = hit_words(hits).join(hit_items(hits, items), TEXT, "left")
    rows = kept.select("doc_id", *TEXT, "n_words").join(written(found, "found"), TEXT, "left")
    return rows.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
with doc_words as (
    select row_number() over () as row_id, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from documents
), item_words as (
    select cast(item_id as varchar) as item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from benchmark
), item_windows as (
    select distinct item_id, size, array_to_string(words[p : p + size - 1], ' ') as w
    from (
        select item_id, words, size, unnest(generate_series(1, len(words) - size + 1)) as p
        from (select *, least(10, len(words)) as size from item_words where len(words) > 0)
    )
), windows as (select distinct size, w from item_windows),
hits as (
    select d.row_id, d.p, d.size, d.w
    from (
        select row_id, size, p, array_to_string(words[p : p + size - 1], ' ') as w
        from (
            select row_id, words, size, unnest(generate_series(1, len(words) - size + 1)) as p
            from doc_words, (select distinct size from windows) where len(words) >= size
        )
    ) d semi join windows using (size, w)
), covered as (
    select row_id, count(distinct place) as n_hit
    from (select row_id, unnest(generate_series(p, p + size - 1)) as place from hits)
    group by row_id
), found as (
    select row_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
    from (select distinct h.row_id, i.item_id from hits h join item_windows i using (size, w) where i.item_id is not null)
    group by row_id
)
select doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join covered using (row_id) left join found using (row_id)
"""

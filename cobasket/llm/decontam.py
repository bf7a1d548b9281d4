"""Benchmark decontamination with DataFrame functions alone.

The benchmark's n-grams of normalised words form a hash set, which is broadcast when its size allows. Documents are
scanned in two steps that together miss nothing. Of n words in a row that are an n-gram of the benchmark, one of every
``stride`` positions starts a part of n - stride + 1 words; so hashing the parts at these positions, a few for each n
words, and looking them up among all parts of the benchmark's n-grams finds every place where a hit can be. There, all
windows around are looked up in the set of n-grams and verified word by word. Both steps run in one pass over the text;
only hits and one row per document leave it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cobasket.llm.common import dropped, free, written

N = 10
BROADCAST_GRAMS = 500_000  # n-grams that are broadcast at most (some 100 MB); beyond, the lookup is a shuffled join
BROADCAST_DOCS = 100_000  # documents with places that are broadcast at most
NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of digits, letters and anything beyond ASCII, A-Z in lower case. Null has none."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lower, f"{NO_WORD}+"), "")


def stride(size: int) -> int:
    return max(1, size // 2)


def _windows(benchmark: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """item, size, gram (words), hash. An item of fewer than ``n`` words, but not none, is one window."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("words")) \
        .filter(F.size("words") > 0).withColumn("size", F.least(F.size("words"), F.lit(n)))
    return items.select("item", "size", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("words") - F.col("size") + 1), lambda i: F.slice("words", i, F.col("size"))))
        .alias("gram")).withColumn("hash", F.xxhash64("gram"))


def grams(benchmark: DataFrame, n: int = N, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The set to look up: number, size, gram, hash; and which items hold which n-gram: number, item. Both stored."""
    windows = _windows(benchmark, n, id_col, text_col)
    wanted = written(windows.select("size", "gram", "hash").distinct().withColumn("number", F.monotonically_increasing_id()),
                     "grams")
    holders = windows.filter("item is not null").select("item", "gram", "hash").distinct()
    return wanted, written(holders.join(wanted, ["hash", "gram"]).select("number", "item"), "gram-items")


def text_key(text: Column) -> Column:
    """What tells texts apart, whatever their ids are."""
    return F.unhex(F.sha2(F.coalesce(text.cast("binary"), F.lit(b"")), 256))


def hits(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents (id, key, n_words), a row each; and the verified hits of each text (key, at, size, number of the
    n-gram), ``at`` being 0 for the first word. Both stored; equal texts share their hits."""
    sizes = sorted(row[0] for row in wanted.select("size").distinct().collect())  # 1 to n: n numbers at most
    hint = F.broadcast if wanted.limit(BROADCAST_GRAMS + 1).count() <= BROADCAST_GRAMS else (lambda df: df)
    split = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"), words(F.col(text_col)).alias("words")) \
        .withColumn("n_words", F.size("words").cast("long"))

    def parts(size: int) -> Column:
        step, part = stride(size), size - stride(size) + 1
        return F.when(F.size("words") >= size, F.transform(
            F.sequence(F.lit(0), F.size("words") - part, F.lit(step)),
            lambda i: F.struct(i.alias("place"), F.lit(size).alias("size"),
                               F.xxhash64(F.lit(size), F.slice("words", i + 1, F.lit(part))).alias("part")))
        ).otherwise(F.array().cast("array<struct<place:int,size:int,part:bigint>>"))

    whole = F.array(F.struct(F.lit(-1).alias("place"), F.lit(0).alias("size"), F.lit(None).cast("bigint").alias("part")))
    known = written(gram_parts(wanted, sizes), "gram-parts")
    rows = split.select("id", "key", "n_words", F.inline(F.concat(whole, *map(parts, sizes))))
    places = written(rows.join(hint(known), "part", "left").filter((F.col("place") < 0) | F.col("known"))
                     .select("id", "key", "n_words", "place", "size"), "places")

    step = F.lit(1)
    for size in sizes:
        step = F.when(F.col("size") == size, stride(size)).otherwise(step)
    per = places.filter("place >= 0").groupBy("key").agg(F.collect_set(
        F.struct("place", "size", step.alias("step"))).alias("places"))
    per = written(per, "texts-with-places")
    small = per.limit(BROADCAST_DOCS + 1).count() <= BROADCAST_DOCS and per.agg(
        F.coalesce(F.sum(F.size("places")), F.lit(0))).first()[0] <= BROADCAST_GRAMS
    again = split.join(F.broadcast(per) if small else per, "key")

    def around(p: Column) -> Column:
        first = F.greatest(F.lit(0), p["place"] - p["step"] + 1)
        last = F.least(p["place"], F.size("words") - p["size"])
        return F.transform(F.sequence(first, last), lambda i: F.struct(
            i.alias("at"), p["size"].alias("size"), F.slice("words", i + 1, p["size"]).alias("window")))

    inside = F.filter("places", lambda p: p["place"] - p["step"] < F.size("words") - p["size"] + 1)
    windows = again.select("key", F.inline(F.flatten(F.transform(inside, around)))).withColumn("hash", F.xxhash64("window"))
    like = windows.join(hint(wanted.select("hash").distinct()), "hash", "left_semi")  # hashes alone are of fixed size
    found = like.join(wanted.select("hash", "gram", "number"), "hash").filter(F.col("window") == F.col("gram"))
    return places.filter("place < 0").select("id", "key", "n_words"), written(
        found.select("key", "at", "size", "number").distinct(), "hits")


def gram_parts(wanted: DataFrame, sizes: list[int]) -> DataFrame:
    """part, known (true): the hashes of all parts of the n-grams that a scan may meet."""
    parts = F.array().cast("array<bigint>")
    for size in sizes:
        part = size - stride(size) + 1
        own = F.transform(F.sequence(F.lit(1), F.lit(stride(size))),
                          lambda i: F.xxhash64(F.lit(size), F.slice("gram", i, F.lit(part))))
        parts = F.when(F.col("size") == size, own).otherwise(parts)
    return wanted.select(F.explode(parts).alias("part")).distinct().withColumn("known", F.lit(True))


def covered(spans: Column) -> Column:
    """How many words the spans (at, size) cover, each word once."""
    start = F.struct(F.lit(0).alias("until"), F.lit(0).cast("long").alias("n"))
    step = lambda acc, s: F.struct(
        F.greatest(acc["until"], s["at"] + s["size"]).alias("until"),
        (acc["n"] + F.greatest(s["at"] + s["size"] - F.greatest(acc["until"], s["at"]), F.lit(0))).alias("n"))
    return F.aggregate(F.sort_array(spans), start, step, lambda acc: acc["n"])


def by_text(docs: DataFrame, benchmark: DataFrame, n: int, id_col: str, text_col: str, item_col: str,
            item_text_col: str) -> tuple[DataFrame, DataFrame]:
    """Documents (id, key, n_words), and for each text with hits: key, spans (at, size), items (sorted). A text's hits
    meet in one row: never more than its own windows, and the items that hold them."""
    wanted, holders = grams(benchmark, n, item_col, item_text_col)
    rows, found = hits(docs, wanted, id_col, text_col)
    spans = found.groupBy("key").agg(F.collect_set(F.struct("at", "size")).alias("spans"))
    items = (found.select("key", "number").distinct().join(holders, "number").select("key", "item").distinct()
             .groupBy("key").agg(F.sort_array(F.collect_list("item")).alias("items")))
    none = F.array().cast("array<string>")
    return rows, written(spans.join(items, "key", "left").select("key", "spans", F.coalesce("items", none).alias("items")),
                         "texts-with-hits")


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = N, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, n_hit, items (sorted), spans (at, size), contaminated.

    Null and empty texts have no words and no hits; an empty benchmark gives no hits, an empty table no rows. Hits belong
    to texts: repeated rows, rows that share an id and rows without one each get a row with the hits of their own text.
    Items without an id count as hits, and not among the items.
    """
    rows, texts = by_text(docs, benchmark, n, id_col, text_col, item_col, item_text_col)
    none, empty = F.array().cast("array<struct<at:int,size:int>>"), F.array().cast("array<string>")
    return rows.join(texts, "key", "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce(covered(F.col("spans")), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", empty).alias("items"), F.coalesce("spans", none).alias("spans")) \
        .withColumn("contaminated", F.col("n_hit") > 0)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N,
                      item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has no hit, with all their columns."""
    _, texts = by_text(docs, benchmark, n, id_col, text_col, item_col, item_text_col)
    own = free(docs, "_key")
    return dropped(docs.withColumn(own, text_key(F.col(text_col))), texts.select(F.col("key").alias(own)), own).drop(own)


def remove_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N,
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` with the hit words, and what separates them from the next word, taken out of the text."""
    _, texts = by_text(docs, benchmark, n, id_col, text_col, item_col, item_text_col)
    own, spans = free(docs, "_key"), free(docs, "_spans")
    joined = docs.withColumn(own, text_key(F.col(text_col))).join(
        texts.select(F.col("key").alias(own), F.col("spans").alias(spans)), own, "left")
    parts = F.regexp_extract_all(F.col(text_col), F.lit(f"^{NO_WORD}+|{WORD}+{NO_WORD}*"), F.lit(0))
    lead = F.when(F.regexp_like(F.col(text_col), F.lit(f"^{NO_WORD}")), 1).otherwise(0)
    clean = F.array_join(F.filter(parts, lambda part, i: ~F.exists(
        spans, lambda s: (i - lead >= s["at"]) & (i - lead < s["at"] + s["size"]))), "")
    return joined.withColumn(text_col, F.when(F.col(spans).isNull(), F.col(text_col)).otherwise(clean)) \
        .select(docs.columns)

"""Operator 8: benchmark decontamination by winnowing, with DataFrame functions only.

Words are hashed, ``K`` of them in a row make a gram, and of each ``SPAN`` grams in a row the least
are kept as fingerprints. Any ``WINDOW`` = K + SPAN - 1 equal words therefore share one. Fingerprints of
documents and benchmark items are joined; each hit is extended to both sides while the words agree, and
counts where at least a whole window does. Items shorter than a window are looked up as
one gram of their own length.

Fingerprints are exploded and joined where a document is read, as long as those of the benchmark are few
enough to be broadcast (``BROADCAST_ROWS``, checked); otherwise both sides are shuffled by fingerprint.
The words of a document are read again only if it has hits.

Defined cases: a null text has no words; items without words match nothing; an item without id has
the empty string as id, and items with equal ids count once; repeated rows and null ids of documents each give
their row; empty tables give no rows, or rows without hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.staging import boxed, staged, unboxed, with_keys

WINDOW = 13
K = 6
SPAN = WINDOW - K + 1
BROADCAST_ROWS = 1 << 18

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of 0-9, a-z and all characters outside ASCII, after A-Z are lower-cased."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(lowered, _BETWEEN), "")


def _hashed(df: DataFrame) -> DataFrame:
    """Adds ``h``, the hashes of the words of ``text``."""
    return df.withColumn("_words", words(F.col("text"))).withColumn("h", F.expr("transform(_words, w -> xxhash64(w))")).drop("_words")


def _fingerprints(df: DataFrame, *columns: str) -> DataFrame:
    """``columns, gram, at`` of the kept grams of ``h``."""
    gram = ", ".join(f"get(h, i + {k})" for k in range(K))
    least = ", ".join(f"get(g, i + {k})" for k in range(SPAN))
    most = ", ".join(f"get(m, i - {k})" for k in range(SPAN))
    # guards and outer generators, as a filter would be pushed below the arrays and make them twice
    df = df.select(*columns, F.expr(f"if(size(h) >= {WINDOW}, transform(sequence(0, size(h) - {K}), i -> xxhash64({gram})), array())").alias("g"))
    df = df.withColumn("m", F.expr(f"if(size(g) >= {SPAN}, transform(sequence(0, size(g) - {SPAN}), i -> least({least})), array())"))
    # a gram is kept if it is the least of some window it stands in
    kept = F.expr(f"filter(transform(g, (x, i) -> if(x = greatest({most}), struct(x as gram, i as at), null)), s -> s is not null)")
    return df.select(*columns, kept.alias("kept")).select(*columns, F.inline_outer("kept"))


def _grams_of(df: DataFrame, size: int, *columns: str) -> DataFrame:
    """``columns, gram, at`` of all grams of ``size`` words."""
    gram = ", ".join(f"get(h, i + {k})" for k in range(size))
    found = F.expr(f"if(size(h) >= {size}, transform(sequence(0, size(h) - {size}), i -> struct(xxhash64({gram}) as gram, i as at)), null)")
    return df.select(*columns, found.alias("kept")).select(*columns, F.inline_outer("kept"))


def _joined(left: DataFrame, right: DataFrame) -> DataFrame:
    """Document grams with item grams; the items' side is broadcast if it is checked to be small."""
    right = staged(right, "winnowing-items")
    small = right.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return left.join(F.broadcast(right) if small else right, "gram").drop("gram")


def _keyed(documents: DataFrame) -> DataFrame:
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(F.xxhash64(doc_id, doc_id.isNull(), text).alias("key"), doc_id.alias("doc_id"), text.alias("text"))


#: Words covered by ``runs``, an array of (begin, end) that may overlap.
_COVERED = """aggregate(array_sort(runs), struct(0 as till, 0L as n),
    (a, r) -> struct(greatest(a.till, r.end) as till, a.n + greatest(0, r.end - greatest(a.till, r.begin)) as n),
    a -> a.n)"""


def hits(keyed: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``key, item_id, begin, end``: runs of words that at least one whole window of an item covers."""
    item_id = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    items = _hashed(benchmark.select(item_id.alias("item_id"), F.col("text")))
    items = staged(items.where(F.size("h") > 0).select("item_id", "h").distinct().withColumn("item", F.xxhash64("item_id", "h")), "benchmark-items")
    place = F.col("at").alias("item_at")
    documents = _hashed(keyed).select("key", "h")
    long_items = items.where(F.size("h") >= WINDOW)
    found = _joined(_fingerprints(documents, "key"), _fingerprints(long_items, "item").select("gram", "item", place))
    # at most twelve lengths
    sizes = [r[0] for r in items.where(F.size("h") < WINDOW).select(F.size("h").alias("n")).distinct().collect()]
    for n in sorted(sizes):
        some = _grams_of(items.where(F.size("h") == n), n, "item").select("gram", "item", place)
        found = found.unionByName(_joined(_grams_of(documents, n, "key"), some))
    found = staged(found, "winnowing-hits")
    entries = found.groupBy("key").agg(F.collect_list(F.struct("at", "item", "item_at")).alias("entries"))
    texts = _hashed(with_keys(keyed.select("key", "text"), found, "key").dropDuplicates(["key"]))
    # the words around each hit: those of a window to its left and to its right
    around = f"transform(entries, e -> struct(e.at, e.item, e.item_at, greatest(0, e.at - {WINDOW}) as first, slice(h, greatest(0, e.at - {WINDOW}) + 1, {3 * WINDOW}) as near))"
    near = texts.join(entries, "key").select("key", F.expr(around).alias("entries")).select("key", F.inline_outer("entries"))
    pairs = near.join(items.select("item", "item_id", F.col("h").alias("theirs")), "item").withColumn("place", F.col("at") - F.col("first"))
    left = F.expr(f"aggregate(sequence(1, {WINDOW - 1}), 0, (n, i) -> if(n = i - 1 and get(near, place - i) = get(theirs, item_at - i), i, n))")
    right = F.expr(f"aggregate(sequence(0, {2 * WINDOW - 2}), 0, (n, i) -> if(n = i and get(near, place + i) = get(theirs, item_at + i), i + 1, n))")
    pairs = pairs.withColumn("left", left).withColumn("right", right)
    pairs = pairs.where(F.col("left") + F.col("right") >= F.least(F.lit(WINDOW), F.size("theirs")))
    return pairs.select("key", "item_id", (F.col("at") - F.col("left")).alias("begin"), (F.col("at") + F.col("right")).alias("end")).distinct()


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: its words, hit words and items, and whether it is contaminated."""
    keyed = _keyed(documents)
    by_document = (
        hits(keyed, benchmark).groupBy("key")
        .agg(F.collect_set(F.struct("begin", "end")).alias("runs"), F.array_sort(F.collect_set("item_id")).alias("items"))
        .select("key", F.expr(_COVERED).alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("ids"))
    )
    counted = keyed.select("key", "doc_id", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return counted.join(by_document, "key", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")).cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    runs = hits(_keyed(documents), benchmark).groupBy("key").agg(F.collect_set(F.struct("begin", "end")).alias("runs"))
    hit = staged(runs.select("key", F.expr(_COVERED).alias("n_hit")), "winnowing-counts")
    rows = boxed(documents, key=F.xxhash64(doc_id, doc_id.isNull(), text))
    some = with_keys(rows, hit, "key").join(hit, "key")
    clean = some.where(20 * F.col("n_hit") < F.size(words(F.col("row.text")))).select("row")
    return unboxed(with_keys(rows, hit, "key", "left_anti").select("row").unionByName(clean), documents.columns)

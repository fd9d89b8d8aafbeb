"""Document fingerprints of closed syncmers, in DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from lodestone.functions.sizes import sent_if_small
from lodestone.llm.common import checkpointed
from lodestone.sources.tables import table

_LETTER, _SIGN = r"[\p{L}\p{M}\p{N}]", r"[^\p{L}\p{M}\p{N}\x20\x09-\x0D]"
#: A token is a run of letters and digits, or of other signs, of up to 16; of a longer run each code point is one. White space only parts
#: them. So what a token is depends on its own run alone, and an insertion changes the tokens of one run, not those after it.
TOKEN = "|".join(rf"(?<!{c}){c}{{1,16}}+(?!{c})|{c}" for c in (_LETTER, _SIGN))
#: In a text of fewer code points than this, each one but white space is a token, so that short texts have several anchors, too.
SHORT, SINGLE = 256, r"[^\x20\x09-\x0D]"
#: A k-mer of 9 tokens has 8 inner s-mers of 2, its window; a quarter of all k-mers are anchors.
INNER, WINDOW = 2, 8
K = INNER + WINDOW - 1
#: What is worked on at once: code points, and tokens in two steps.
CHARS, LARGE, SMALL = 30_000, 1 << 16, 1 << 11
SLICE = rf"(?s).{{1,{CHARS}}}+[^\x20\x09-\x0D]{{0,{CHARS}}}+"
#: Bits of an anchor's hash, and of its position beside it.
HASH_BITS, POS_BITS = 32, 31
#: Anchors match if they are off from the usual offset by at most this part of the longer text.
SLACK = 8
#: 256 ids make a bucket of neighbours, whose rows are sorted and buffered together; so do as many rows of one id.
SPAN_BITS = 8
#: Buckets up to which their order is found by one sort, and are sent to all executors: 24 bytes each.
FLAT, SENT = 50_000, 1_000_000
NO_ID = -(1 << 62)
NONE = "cast(array() as array<bigint>)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_anchors(rows: DataFrame, text: str, out: str) -> DataFrame:
    """The rows with the closed syncmers of a text column, in order: each a hash of 32 bits and, in the lower 31, the number of its first token.

    A k-mer of tokens counts if the least hash of its s-mers is that of its first or its last one.
    Whether it does depends on the k-mer alone, so a k-mer that two texts share is an anchor in
    both. A text of fewer tokens, but not an empty one, has one anchor, the whole text, at 0. Tokens are words, or the
    code points of a short text or a long run: see ``TOKEN`` and ``SHORT``.

    A text is worked on slice by slice, of ``CHARS`` code points and on to white space (or as many more
    without any), then of tokens that overlap by a k-mer, so that of a very long one only its hashes
    and its anchors are held in full.
    """
    hashes = lambda s, pattern: F.transform(F.regexp_extract_all(s, F.lit(pattern), F.lit(0)), lambda t: F.xxhash64(t))
    sliced = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(SLICE), F.lit(0)), lambda s: hashes(s, TOKEN)))
    rows = rows.withColumn("_t", F.when(F.char_length(text) < SHORT, hashes(F.col(text), SINGLE)).otherwise(sliced))
    parts = lambda a, size: F.transform(F.sequence(F.lit(0), F.size(a) - K, F.lit(size)), lambda i: F.slice(a, i + 1, F.lit(size + K - 1)))
    within = lambda o, n: F.flatten(F.transform(parts(o, SMALL), lambda x, k: anchors(x, n * LARGE + k * SMALL)))
    found = F.flatten(F.transform(parts(F.col("_t"), LARGE), within))
    whole = F.array(anchor(F.xxhash64(text), F.lit(0)))
    return rows.withColumn(out, F.when(F.size("_t") >= K, found).when(F.char_length(text) > 0, whole).otherwise(F.expr(NONE))).drop("_t")


def anchors(tokens: Column, begin: Column) -> Column:
    """The anchors among K tokens or more, of which the first is number ``begin``; the least of 8 neighbours is found by doubling: of 2, 4, 8."""
    shifted = lambda a, n: F.slice(a, n + 1, F.size(a))
    pairs = lambda a: F.zip_with(a, shifted(a, INNER - 1), lambda x, y: F.xxhash64(x, y))
    least = lambda n: lambda a: F.zip_with(a, shifted(a, n), lambda x, y: F.least(x, y))
    # these s-mers cover the k-mer
    cover = [*range(0, WINDOW, INNER), WINDOW - 1]
    made = lambda h, i: anchor(F.xxhash64(*[F.get(h, i + n) for n in cover]), begin + i)
    edge = lambda h, m: lambda i: (F.get(m, i) == F.get(h, i)) | (F.get(m, i) == F.get(h, i + (WINDOW - 1)))
    places = lambda h, m: F.filter(F.sequence(F.lit(0), F.size(tokens) - K), edge(h, m))
    return let(pairs(tokens), lambda h: let(let(let(least(1)(h), least(2)), least(4)), lambda m: F.transform(places(h, m), lambda i: made(h, i))))


def anchor(hashed: Column, place: Column) -> Column:
    return F.shiftleft(hashed.bitwiseAND(F.lit((1 << HASH_BITS) - 1)), POS_BITS).bitwiseOR(place.cast("long"))


def hash_of(anchor: Column) -> Column:
    return F.shiftrightunsigned(anchor, POS_BITS)


def pos_of(anchor: Column) -> Column:
    return anchor.bitwiseAND(F.lit((1 << POS_BITS) - 1))


def with_likeness(rows: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """The rows with how alike two columns of anchors are, by hash and place: 0 to 1, of two empty ones 1.

    Of each text the first place of each hash counts. Hashes that both have make pairs of places, each
    with an offset; a pair matches if its offset is near the median one, so that what was
    moved elsewhere doesn't match. Repeats beyond the first match by their number. The likeness is the share of
    what matches in all anchors of both.
    """
    new = lambda c: lambda x, i: (i == 0) | (hash_of(F.get(F.col(c), i - 1)) != hash_of(x))
    rows = rows.withColumn("_s0", F.sort_array(a)).withColumn("_s1", F.sort_array(b))
    rows = rows.withColumn("_f0", F.filter("_s0", new("_s0"))).withColumn("_f1", F.filter("_s1", new("_s1")))
    # hash, place and side in 64 bits: the two sides of a hash are neighbours
    side = lambda k: F.transform(f"_f{k}", lambda x: F.shiftleft(x, 1).bitwiseOR(F.lit(k)))
    rows = rows.withColumn("_both", F.sort_array(F.concat(side(0), side(1)))).drop("_s0", "_s1")
    entry = lambda i: F.get(F.col("_both"), i)
    place = lambda i: pos_of(F.shiftrightunsigned(entry(i), 1))
    is_b = lambda i: entry(i).bitwiseAND(F.lit(1))
    same = lambda i: F.shiftrightunsigned(entry(i), POS_BITS + 1) == F.shiftrightunsigned(entry(i + 1), POS_BITS + 1)
    pairs = F.filter(F.sequence(F.lit(0), F.greatest(F.size("_both") - 2, F.lit(0))), same)
    rows = rows.withColumn("_off", F.sort_array(F.transform(pairs, lambda i: (place(i + 1) - place(i)) * (is_b(i + 1) - is_b(i)))))
    longer = F.greatest(*[F.coalesce(pos_of(F.get(F.col(c), F.size(c) - 1)), F.lit(0)) for c in (a, b)])
    usual = F.get(F.col("_off"), F.shiftright(F.size("_off"), 1))
    rows = rows.withColumn("_usual", usual).withColumn("_near", longer / SLACK)
    matched = F.size(F.filter("_off", lambda o: F.abs(o - F.col("_usual")) <= F.col("_near")))
    repeats = F.least(F.size(a) - F.size("_f0"), F.size(b) - F.size("_f1"))
    rows = rows.withColumn("_hit", F.when(matched > 0, matched + repeats).otherwise(F.lit(0)))
    every = F.size(a) + F.size(b) - F.col("_hit")
    return rows.withColumn(out, F.when(every == 0, F.lit(1.0)).otherwise(F.col("_hit") / every).cast("double")).drop("_f0", "_f1", "_both", "_off", "_usual", "_near", "_hit")


def written(anchors: str) -> Column:
    """Anchors as a string, in the order of the text: 8 hexadecimal digits for each hash."""
    return F.array_join(F.transform(anchors, lambda v: F.lpad(F.lower(F.hex(hash_of(v))), 8, "0")), "")


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, positions (numbers of tokens) and anchors (hashes) of each row; null text counts as empty, which has none."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    found = with_anchors(rows, "_text", "_a")
    return found.select(F.col("_id").alias(id_col), F.transform("_a", lambda v: pos_of(v).cast("int")).alias("positions"), F.transform("_a", hash_of).alias("anchors"))


def successors(keys: DataFrame, n: int) -> DataFrame:
    """(key, next) of distinct keys (bucket, part): the next larger one, and of the largest the smallest.

    Up to ``FLAT`` keys are sorted by one task. More are grouped by spans of buckets, whose own order
    is found in the same way, so that no task sorts more than a span.
    """
    if n <= FLAT:
        order = Window.orderBy("key")
        return keys.select("key", F.coalesce(F.lead("key").over(order), F.first("key").over(order)).alias("next"))
    span = F.struct(F.shiftright("key.bucket", SPAN_BITS).alias("bucket"), F.lit(0).cast("long").alias("part"))
    spans = keys.withColumn("_span", span)
    firsts = spans.groupBy("_span").agg(F.min("key").alias("_first"))
    follow = successors(firsts.select(F.col("_span").alias("key")), firsts.count()).withColumnRenamed("key", "_span")
    begins = firsts.select(F.col("_span").alias("next"), F.col("_first").alias("_begin"))
    order = Window.partitionBy("_span").orderBy("key")
    return spans.join(follow.join(begins, "next").select("_span", "_begin"), "_span").select("key", F.coalesce(F.lead("key").over(order), F.col("_begin")).alias("next"))


def in_buckets(rows: DataFrame) -> DataFrame:
    """The rows with their _bucket: (bucket, part), in the order of the rows by id and then by _hash.

    A bucket is a span of ids. One in which an id, or null, has more rows than a span has ids is dealt
    into parts: one for each id, or several ranges of the hash for such an id.
    """
    span = lambda c: F.when(F.col(c).isNull(), F.lit(NO_ID)).otherwise(F.shiftright(c, SPAN_BITS))
    counts = rows.groupBy("_id").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > (1 << SPAN_BITS))
    hot = checkpointed(counts.select(F.col("_id").alias("_hot"), span("_id").alias("_within"), F.ceil(F.log2(F.col("_rows") / (1 << SPAN_BITS))).cast("int").alias("_bits")))
    if not hot.limit(1).count():
        return rows.withColumn("_bucket", F.struct(span("_id").alias("bucket"), F.lit(0).cast("long").alias("part")))
    by_id = rows.withColumn("_span", span("_id")).join(sent_if_small(hot.select(F.col("_within").alias("_span"), F.lit(True).alias("_dealt")).distinct()), "_span", "left")
    by_id = by_id.join(sent_if_small(hot.select("_hot", "_bits")), F.col("_id").eqNullSafe(F.col("_hot")), "left")
    number = F.shiftleft(F.coalesce(F.col("_id").bitwiseAND(F.lit((1 << SPAN_BITS) - 1)), F.lit(0)), 48)
    # the hash's order is that of signed numbers
    within = F.expr("shiftrightunsigned(_hash ^ -9223372036854775808, 64 - _bits)")
    part = F.when(F.col("_dealt"), number + F.when(F.col("_bits") > 0, within).otherwise(F.lit(0))).otherwise(F.lit(0)).cast("long")
    return by_id.withColumn("_bucket", F.struct(F.col("_span").alias("bucket"), part.alias("part"))).drop("_span", "_dealt", "_hot", "_bits")


def beside_next(rows: DataFrame) -> DataFrame:
    """Rows (_id, _text) in order within buckets of neighbours: _bucket, _guest, _id, _hash, _text.

    Each bucket also gets, as a guest after its own rows, the first row of the bucket after it
    (the last gets that of the first), so that every row's next one is in its own bucket. The text
    crosses one exchange.
    """
    rows = in_buckets(rows.withColumn("_hash", F.xxhash64("_text")))
    firsts = rows.groupBy("_bucket").agg(F.min(F.struct("_id", "_hash")).alias("_first"))
    n = firsts.count()
    before = successors(firsts.select(F.col("_bucket").alias("key")), n).select(F.col("next").alias("_of"), F.col("key").alias("_before"))
    guests = firsts.join(before, F.col("_bucket") == F.col("_of")).select("_first", "_before")
    guests = F.broadcast(guests) if n <= SENT else guests
    sent = rows.join(guests, F.col("_id").eqNullSafe(F.col("_first._id")) & (F.col("_hash") == F.col("_first._hash")))
    sent = sent.select(F.col("_before").alias("_bucket"), F.lit(1).alias("_guest"), "_id", "_hash", "_text")
    every = rows.select("_bucket", F.lit(0).alias("_guest"), "_id", "_hash", "_text").unionByName(sent)
    return every.repartition("_bucket").sortWithinPartitions("_bucket", "_guest", "_id", "_hash", "_text")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's fingerprint beside those of its edited text and of the next row.

    The edited text has the last half of the code points replaced by as many first ones of the next
    row by id (of the last row: the first). The id column holds whole numbers, else a TypeError says
    so. Null ids come first, equal ids are ordered by a hash of the text and by the text; a single
    row is its own next. An id with very many rows, or null, is dealt to several tasks; only rows
    of equal id and text stay together.
    """
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col}: next documents are found by whole numbers, not by {docs.schema[id_col].dataType.simpleString()}")
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rows = with_anchors(beside_next(rows), "_text", "_own")
    order = Window.partitionBy("_bucket").orderBy("_guest", "_id", "_hash", "_text")
    rows = rows.select("*", F.lead("_text").over(order).alias("_next_text"), F.lead("_own").over(order).alias("_next")).where("_guest = 0")
    half = F.shiftright(F.char_length("_text"), 1)
    edited = F.concat(F.expr("substring(_text, 1, char_length(_text) - _half)"), F.expr("substring(_next_text, 1, _half)"))
    rows = rows.withColumn("_half", half).withColumn("_edited", edited).withColumn("_size", F.char_length("_text")).drop("_text", "_next_text")
    rows = with_anchors(rows.withColumn("_sha", F.sha2("_edited", 256)), "_edited", "_new").drop("_edited")
    rows = with_likeness(with_likeness(rows, "_own", "_new", "_near_edited"), "_own", "_next", "_near_next")
    return rows.select(
        F.col("_id").cast(kind).alias(id_col),
        F.col("_size").cast("long").alias("n_chars"),
        F.col("_sha").alias("edited_sha256"),
        written("_own").alias("fingerprint"),
        written("_new").alias("edited_fingerprint"),
        F.col("_near_edited").alias("near_edited"),
        F.col("_near_next").alias("near_next"),
    )


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they and the next document's are; as of ``edited_fingerprints``."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))

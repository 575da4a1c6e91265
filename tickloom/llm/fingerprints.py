"""Document fingerprints of closed syncmers, in Spark's own functions only.

A window of ``K`` code points is an anchor if, of the hashes of the ``S`` code points at each of its places, the first
or the last is the least (a closed syncmer).  Whether it is depends on the window alone, so equal passages have equal
anchors wherever they stand, and a text's anchors are those of its parts and of the seams between them.  A fingerprint
is the ``SIZE`` anchors with the smallest keys, each with the place where it comes first; those of parts merge into
that of the whole.  Likeness is the share of anchors that two texts have in common (estimated from the smallest keys of
both together), times the share of neighbouring common anchors that stand in the same order in both.

Defined results: a null text is an empty one.  A text without an anchor (shorter than about ``K`` code points) has one
entry, the hash of the whole text at place 0, so equal texts have equal fingerprints and likeness 1.  Rows without an
id come first; rows of one id go by the hash of their text, then by it.  Of repeated rows (equal id and text) each has
a copy of itself as the next one, but for the last.  A single document is its own next one.  An empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import partitions, written

K, S = 12, 8
#: Anchors of a fingerprint.
SIZE = 48
#: Code points that are looked at together, so that a long text needs no more memory than a short one.
SEGMENT = 1 << 16
#: Rows that the edges of a range are chosen from, and edges that one look at the coarse list spares.
SAMPLE, FAN = 32, 256


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _named(**fields: Column) -> Column:
    return F.named_struct(*[x for name, value in fields.items() for x in (F.lit(name), value)])


def _entry(key: Column, place: Column) -> Column:
    return F.shiftleft(key.bitwiseAND(F.lit(0x7FFFFFFF)), 32).bitwiseOR(place.cast("long"))


def _key(entry: Column) -> Column:
    return F.shiftright(entry, 32)


def _place(entry: Column) -> Column:
    return entry.bitwiseAND(F.lit(0xFFFFFFFF))


def anchors(text: Column, base: Column | None = None) -> Column:
    """The closed syncmers of a text as an array of longs, 31 bits of key above the place (from ``base``)."""
    inner = F.transform(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{S}}}))."), F.lit(1)), lambda x: F.xxhash64(x))
    last = K - S
    base = F.lit(0) if base is None else base

    def chosen(h: Column) -> Column:
        edge = lambda i: F.least(h[i], h[i + last]) <= F.least(*[h[i + j] for j in range(1, last)])
        places = F.filter(F.sequence(F.lit(0), F.size(h) - last - 1), edge)
        found = F.transform(places, lambda i: _entry(F.xxhash64(h[i], h[i + last]), base + i))
        return F.when(F.size(h) > last, found).otherwise(F.array().cast("array<bigint>"))

    return _let(inner, chosen)


def smallest(entries: Column) -> Column:
    """The ``SIZE`` entries with the smallest keys, each key at its first place."""
    distinct = lambda s: F.filter(s, lambda e, i: (i == 0) | (_key(e) != _key(s[F.greatest(i - 1, F.lit(0))])))

    def chosen(s: Column) -> Column:
        # the first few are mostly enough
        few = _let(F.slice(s, 1, 4 * SIZE), distinct)
        return _let(few, lambda f: F.when((F.size(f) >= SIZE) | (F.size(s) <= 4 * SIZE), f).otherwise(_let(s, distinct)))

    return F.slice(_let(F.sort_array(entries), chosen), 1, SIZE)


def _segments(text: Column, use: Callable[[Column], Column]) -> Column:
    """``use(anchors)`` of every segment of a text; segments overlap, so that each window lies in one of them."""
    count = F.floor(F.greatest(F.length(text) - K, F.lit(0)) / SEGMENT).cast("int")
    return F.transform(F.sequence(F.lit(0), count), lambda j: use(anchors(F.substring(text, j * SEGMENT + 1, F.lit(SEGMENT + K - 1)), j * SEGMENT)))


def _closed(entries: Column, text: Column) -> Column:
    return F.when(F.size(entries) > 0, entries).otherwise(F.array(_entry(F.xxhash64(text), F.lit(0))))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text as a sorted array of entries."""
    text = F.coalesce(text, F.lit(""))
    return _closed(smallest(F.flatten(_segments(text, smallest))), text)


def readable(entries: Column) -> Column:
    """A fingerprint as text: key and place of each entry in hexadecimal."""
    one = lambda e: F.concat_ws(":", F.lower(F.lpad(F.hex(_key(e)), 8, "0")), F.lower(F.hex(_place(e))))
    return F.array_join(F.transform(entries, one), " ")


def likeness(a: Column, b: Column) -> Column:
    """How like two fingerprints are, from 0 to 1; 1 for equal ones."""
    keys = lambda x: F.transform(x, _key)

    def scored(both: Column) -> Column:
        a, b, common = both["a"], both["b"], both["common"]
        least = F.slice(F.sort_array(F.array_union(keys(a), keys(b))), 1, SIZE)
        jaccard = F.size(F.array_intersect(least, common)) / F.size(least)
        among = lambda x: F.transform(F.filter(x, lambda e: F.array_contains(common, _key(e))), _place)
        pairs = F.sort_array(F.zip_with(among(a), among(b), lambda x, y: F.named_struct(F.lit("x"), x, F.lit("y"), y)))
        rising = lambda p: F.size(F.filter(p, lambda e, i: (i == 0) | (e["y"] > p[F.greatest(i - 1, F.lit(0))]["y"])))
        order = _let(pairs, rising) / F.greatest(F.size(common), F.lit(1))
        return 2 * jaccard / (1 + jaccard) * order

    return _let(_named(a=a, b=b, common=F.array_intersect(keys(a), keys(b))), scored)


def _bucket(edges: Column, key: Column) -> Column:
    """How many of the sorted edges are not above the key: every ``FAN``-th is looked at first, then those between."""
    passed = lambda some: F.size(F.filter(some, lambda e: e <= key))
    coarse = F.filter(edges, lambda e, i: i % FAN == FAN - 1)
    return _let(passed(coarse), lambda c: c * FAN + passed(F.slice(edges, c * FAN + 1, FAN)))


def with_next(rows: DataFrame, keyed: DataFrame, carried: list[str]) -> DataFrame:
    """Rows with columns id, hash and text, distinct in id and text, and the carried columns of the following row as ``next_...``.

    ``keyed`` has the ids and hashes of all rows, again and again if need be.  Rows are dealt to ranges of (id, hash).  The first row of each range is dealt to the range before too, and that of
    the first range to the last one, so every row meets its follower without an order over all rows.  The edges come
    from a bounded sample; every row is in a range.
    """
    count = partitions(rows.sparkSession)
    keys = written(keyed.select(F.struct("id", "hash").alias("key")), "order")
    sample = keys.orderBy(F.xxhash64("key.id", "key.hash"), "key").limit(SAMPLE * count)
    sorted_keys = F.sort_array(F.collect_list("key"))
    # one edge a range comes to the driver
    found = sample.agg(F.to_json(F.array_distinct(F.filter(sorted_keys, lambda _, i: i % SAMPLE == SAMPLE - 1)))).first()[0]
    edges = F.from_json(F.lit(found), "array<struct<id:bigint,hash:bigint>>")
    everywhere = Window.orderBy("bucket")
    # one row a range
    firsts = keys.groupBy(_bucket(edges, F.col("key")).alias("bucket")).agg(F.min("key").alias("first"))
    before = F.lag("bucket").over(everywhere)
    last = F.max("bucket").over(everywhere.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    extra = written(firsts.select("first", F.struct(F.coalesce(before, last).alias("bucket"), F.lit(True).alias("extra"), before.isNull().alias("wrapped")).alias("more")), "firsts")
    own = F.struct(_bucket(edges, F.struct("id", "hash")).alias("bucket"), F.lit(False).alias("extra"), F.lit(False).alias("wrapped"))
    # bounded: as many rows as shuffle partitions
    met = rows.withColumn("own", own).join(F.broadcast(extra), F.struct("id", "hash") == F.col("first"), "left")
    dealt = met.withColumn("in", F.explode(F.filter(F.array("own", "more"), lambda x: x.isNotNull())))
    order = Window.partitionBy("in.bucket").orderBy("in.wrapped", "id", "hash", "text")
    return dealt.withColumns({f"next_{c}": F.lead(c).over(order) for c in carried}).filter(~F.col("in.extra")).drop("own", "more", "first", "in")


def edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document beside its edited text, whose last quarter is replaced by the beginning of the next document.

    The edited text's fingerprint is merged from that of the part that stays, taken from the text's own anchors, and
    that of the seam and what follows.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    keyed = rows.withColumn("hash", F.xxhash64("text"))
    # an id and a text that come again are one row with a count
    rows = keyed.groupBy("id", "hash", "text").agg(F.count(F.lit(1)).alias("copies"))
    stays = F.length("text") - F.floor(F.length("text") / 4)
    # windows that begin here or later reach beyond the part that stays
    seam = F.greatest(F.lit(0), stays - K + 1).cast("int")
    rows = rows.withColumns({"stays": stays.cast("int"), "seam": seam})
    side = lambda e, before: smallest(F.filter(e, lambda x: (_place(x) < F.col("seam")) == before))
    parts = _segments(F.col("text"), lambda e: _let(e, lambda e: _named(early=side(e, True), late=side(e, False))))
    both = lambda p: F.concat(F.flatten(p["early"]), F.flatten(p["late"]))
    merged = lambda p: _named(all=smallest(both(p)), early=smallest(F.flatten(p["early"])))
    # early entries that are among all of them need not travel twice
    rest = F.array_except("print.early", "print.all")
    rows = rows.withColumn("print", _let(parts, merged)).withColumns({"all": F.col("print.all"), "rest": rest}).drop("print")
    rows = with_next(rows, keyed, ["text", "all"])
    one = lambda text, found, times: _named(text=text, all=found, times=times)
    own = _closed(F.col("all"), F.col("text"))
    following = one(F.col("next_text"), _closed(F.col("next_all"), F.col("next_text")), F.lit(1).cast("long"))
    itself = one(F.col("text"), own, F.col("copies") - 1)
    rows = rows.withColumn("after", F.explode(F.when(F.col("copies") > 1, F.array(following, itself)).otherwise(F.array(following))))
    head = F.substring("after.text", F.lit(1), F.length("text") - F.col("stays"))
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("stays")), head))
    tail = F.substring("edited", F.col("seam") + 1, F.length("edited"))
    early = F.filter("all", lambda x: _place(x) < F.col("seam"))
    late = F.flatten(_segments(tail, lambda e: smallest(F.transform(e, lambda x: x + F.col("seam")))))
    rows = rows.withColumn("edited_print", _closed(smallest(F.concat(early, "rest", late)), F.col("edited")))
    return rows.select(
        F.col("id").alias("doc_id"),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        readable(own).alias("fingerprint"),
        readable(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(own, F.col("edited_print")).alias("near_edited"),
        likeness(own, F.col("after.all")).alias("near_next"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("after.times"))).alias("copy"),
    ).drop("copy")

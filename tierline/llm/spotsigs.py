"""SpotSigs fingerprints.

A common word (an anchor) followed by a chain of content words is a spot signature; the set of
a text's signatures is its fingerprint. Two fingerprints are compared by Jaccard similarity. Sets
whose lengths differ too much cannot be similar, so length parts the sets before any comparison.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import arrow_map, by_ranges, checkpointed, shuffle_width, texts_of, words

#: Common words of four languages. All are skipped in chains and are anchors.
COMMON = frozenset(
    """a an and are as at be been but by for from had has have he her his in is it its not of on or that the their
    they this to was were which who will with you
    à au aux avec ce ces dans de des du elle en est et il ils la le les leur ne pas par pour qui que sa se son sont
    sur un une
    als am auch auf aus bei das dem den der die ein eine einen er es für hat ich im ist mit nicht sich sie sind so
    und von war wie zu zum zur
    al como con cuando del el ella ese esta este está ha las lo los más muy no o para pero por porque su sus una y
    """.split()
)
#: Words of a chain, and how many content words apart they are.
CHAIN, STEP = 3, 1
SIGNATURE = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
    *(T.StructField(n, T.StringType()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")),
    *(T.StructField(n, T.DoubleType()) for n in ("near_edited", "near_next"))])


def signatures(text: str) -> set[str]:
    """16 hex digits for each distinct signature of a text.

    The start of a text is an anchor too, so every text with a content word has a signature; the
    chain at the end may be shorter, but has a word. Without content words, all words are one chain.
    """
    tokens = words(text)
    content = [(i, w) for i, w in enumerate(tokens) if w not in COMMON]
    if not content:
        return {xxhash.xxh3_64_hexdigest(" ".join(tokens))} if tokens else set()
    places, chain = [i for i, _ in content], [w for _, w in content]
    out, last = set(), -1
    for anchor, at in [("", -1), *((w, i) for i, w in enumerate(tokens) if w in COMMON)]:
        first = bisect_left(places, at, max(last, 0))
        last = first
        if first < len(chain) and (first + (CHAIN - 1) * STEP < len(chain) or not anchor):
            out.add(xxhash.xxh3_64_hexdigest(" ".join([anchor, *chain[first : first + CHAIN * STEP : STEP]])))
    return out


def jaccard(a: set[str], b: set[str], at_least: float = 0.0) -> float:
    """Similarity of two sets, 1 for two empty ones; 0 if lengths alone rule ``at_least`` out."""
    if not a or not b:
        return float(not a and not b)
    if min(len(a), len(b)) < at_least * max(len(a), len(b)):
        return 0.0
    shared = len(a & b)
    return shared / (len(a) + len(b) - shared)


def printed(signs: set[str]) -> str:
    return " ".join(sorted(signs))


def edited(text: str, following: str) -> str:
    """The last half of a text replaced by the first as many code points (or all) of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """Rows (_range, tail, id, text) so dealt out that each text's successor follows it in its partition.

    Ranges of ids make up partitions. The first row of each range is also sent, marked as tail,
    to the end of the range before; the first of all goes to the end of the last.
    """
    parts = shuffle_width(df.sparkSession)
    rows = by_ranges(df.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text")), "id", parts)
    # One row for each range comes to the driver.
    head = F.min(F.struct(F.col("id").isNotNull().alias("known"), "id"))
    heads = {r["_range"]: r["h"]["id"] for r in rows.groupBy("_range").agg(head.alias("h")).collect()}
    order = sorted(heads)
    ahead = {b: order[i - 1] for i, b in enumerate(order)}
    if not order:
        return rows.select("_range", F.lit(False).alias("tail"), "id", "text")
    back = F.create_map(*[F.lit(x) for b in order for x in (b, ahead[b])])
    first = F.create_map(*[x for b in order for x in (F.lit(b), F.lit(heads[b]).cast("long"))])
    here = F.struct(F.col("_range").alias("_range"), F.lit(False).alias("tail"))
    there = F.struct(F.element_at(back, F.col("_range")).alias("_range"), F.lit(True).alias("tail"))
    is_head = F.col("id").eqNullSafe(F.element_at(first, F.col("_range")))
    places = F.explode(F.when(is_head, F.array(here, there)).otherwise(F.array(here)))
    dealt = rows.select(places.alias("p"), "id", "text").select("p.*", "id", "text")
    return dealt.repartitionById(parts, F.col("_range")).sortWithinPartitions("tail", "id", "text")


def fingerprints(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``df``: the fingerprint of its text and of its edited text, and likenesses.

    A null text is empty; an empty text has an empty fingerprint, like only to another empty one. Null
    ids come first; rows that share an id follow one another by text. The only row of a table is its own
    successor. An empty table gives no rows. A task holds two texts besides an Arrow batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        done = False
        for batch in batches:
            rows = zip(batch.column("tail").to_pylist(), batch.column("id").to_pylist(), texts_of(batch, "text"), strict=True)
            out = []
            for tail, doc, body in rows:
                if done:
                    break
                signs = signatures(body)
                if held is not None:
                    doc0, body0, signs0 = held
                    changed = edited(body0, body)
                    signs1 = signatures(changed)
                    sha = hashlib.sha256(changed.encode()).hexdigest()
                    out.append(
                        (doc0, len(body0), sha, printed(signs0), printed(signs1), jaccard(signs0, signs1), jaccard(signs0, signs))
                    )
                held, done = (doc, body, signs), tail
            columns = list(zip(*out, strict=True)) if out else [()] * len(SIGNATURE)
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=SIGNATURE.names)

    out = arrow_map(with_next(df, id_column, text), run, SIGNATURE)
    return out.withColumnRenamed("doc_id", id_column)


def similar_sets(sets: DataFrame, at_least: float = 0.8) -> DataFrame:
    """Pairs (a, b, likeness) of different fingerprints at least so alike; a, b are fingerprints, a < b.

    ``sets`` has a column ``fingerprint``; equal ones count once, so copies are no pairs. Sets are parted
    by length into bands so wide that a partner is in the same band or the next. Inside, a set is filed
    under its rarest signatures only: two sets that are alike enough share one of their
    ``n - ceil(at_least * n) + 1`` rarest. Empty fingerprints have no partner.
    """
    one = sets.select("fingerprint").where("fingerprint <> ''").distinct()
    one = checkpointed(one.withColumns({"key": F.xxhash64("fingerprint"), "signs": F.split("fingerprint", " ")}))
    each = one.select("key", F.size("signs").alias("n"), F.explode("signs").alias("sign"))
    often = each.groupBy("sign").agg(F.count("*").alias("often"))
    ordered = each.join(often, "sign").groupBy("key", "n").agg(F.array_sort(F.collect_list(F.struct("often", "sign"))).alias("by"))
    first = F.expr(f"slice(by, 1, n - cast(ceil({at_least} * n - 1e-9) as int) + 1)")
    band = F.floor(F.log("n") / -F.log(F.lit(at_least)) + 1e-9)
    filed = ordered.select("key", "n", band.alias("band"), F.explode(first).alias("p")).select("key", "n", "band", "p.sign")
    near = filed.select("key", "n", "sign", F.explode(F.array("band", F.col("band") - 1)).alias("band"))
    close = (F.col("x.n") >= at_least * F.col("y.n") - 1e-9) & (F.col("y.n") >= at_least * F.col("x.n") - 1e-9)
    pairs = (
        filed.alias("x")
        .join(near.alias("y"), (F.col("x.band") == F.col("y.band")) & (F.col("x.sign") == F.col("y.sign")))
        .where(close & (F.col("x.key") != F.col("y.key")))
        .select(F.least("x.key", "y.key").alias("k"), F.greatest("x.key", "y.key").alias("l"))
        .distinct()
    )
    left = one.select(F.col("key").alias("k"), F.col("fingerprint").alias("f"), F.col("signs").alias("s"))
    right = one.select(F.col("key").alias("l"), F.col("fingerprint").alias("g"), F.col("signs").alias("t"))
    shared = F.size(F.array_intersect("s", "t"))
    alike = shared / (F.size("s") + F.size("t") - shared)
    both = pairs.join(left, "k").join(right, "l").withColumn("likeness", alike).where(F.col("likeness") >= at_least)
    return both.select(F.least("f", "g").alias("a"), F.greatest("f", "g").alias("b"), "likeness")

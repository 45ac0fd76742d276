"""Near-duplicate documents: fast similarity sketches, banding and exact verification.

A sketch has T coordinates. In round i < T every element is thrown into a random coordinate and leaves the value (i, hash) there,
of which the least stays; in round T + j every element goes to coordinate j. After all rounds every coordinate is full, for sets
of any size, and most sketches are full after few rounds; only unfilled ones go on. Two sketches agree in a coordinate with the
probability of the sets' similarity, and the number of agreements is concentrated as for T independent samples.

Rows of the sketch form bands; sets with an equal band are candidates. There are so many bands that a pair just at the threshold has
no common band with a probability of 3e-7 at most (48 bands of 8 rows for 0.85, 64 of 7 rows for 0.8).

Equal sets are one class, known by its smallest id, before anything is compared, so copies never meet. In each band's bucket the
members refer to the smallest id as their centre, if one bit of each coordinate says that they are at all alike. Where some member
is too far from the centre, these members and those at the edge meet again under the smallest id among them, and so on. The edge is
as wide as the bits of two linked sets can differ, so one of them never stays behind without the other. What a few rounds leave of
a bucket is settled by the same steps inside tasks, on the bits, in cells in which any two members meet.

The documents of a centre are compared with it on the full sets, block by block, so each text goes out once for a centre. Those not
linked to it are then compared with all others of the group, by counting common shingles: at once where the group is one block,
else in cells of two blocks, one of them of such loose members. A cell sends only the links of a spanning forest.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.llm import batches, spans
from haulage.llm.components import components
from haulage.operators.lookup import sized
from haulage.operators.skew import HOT_SHARE
from haulage.session import scratch

#: Chance that a pair at the threshold shares no band.
MISSED = 3e-7
#: Members of one centre that are compared at once.
BLOCK = 512
#: Estimated similarity to the centre below which a member has to look for another centre in its bucket.
ALIKE = 0.3
#: Chance that the bits of a pair at the threshold differ in more places than `edge_for` says.
STRAYED = 1e-9
#: Centres that a bucket has by Spark grouping; the members that are left then meet in cells.
ROUNDS = 3
_EMPTY = np.iinfo(np.uint64).max
_COLUMNS = 2048

SKETCH = "doc long, n_shingles long, one long, two long, bands array<long>, bits array<long>"


def rows_for(percent: int) -> int:
    """Rows of a band: chance candidates are few with 8, and with 7 where more bands would be needed."""
    return 8 if percent >= 85 else 7


def bands_for(percent: int) -> int:
    """Bands needed for a similarity of `percent`."""
    return math.ceil(math.log(MISSED) / math.log(1 - (percent / 100) ** rows_for(percent)) / 8) * 8


def edge_for(percent: int) -> int:
    """Bits in which two sets with a similarity of `percent` differ at most: a binomial bound, the chance of more is STRAYED."""
    width, p = bands_for(percent) * rows_for(percent), (1 - percent / 100) / 2
    left = 0.0
    for n in range(width, 0, -1):
        left += math.exp(math.lgamma(width + 1) - math.lgamma(n + 1) - math.lgamma(width - n + 1) + n * math.log(p) + (width - n) * math.log1p(-p)) if p else 0.0
        if left > STRAYED:
            return n
    return 0


def far_for(percent: int) -> int:
    """Bits in which a member and its centre may differ."""
    return max(int((1 - ALIKE) / 2 * bands_for(percent) * rows_for(percent)), edge_for(percent))


class Sets:
    """Distinct shingles of texts as sorted 64-bit hashes: `words` words in A-Z lower case; fewer words are one shingle."""

    def __init__(self, words: int):
        self.words, self.hashes = words, batches.WordHashes()

    def of(self, text: bytes) -> np.ndarray:
        own = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
        if not own:
            return np.zeros(0, np.uint64)
        values, size = self.hashes.of(own), min(self.words, len(own))
        found = np.full(len(own) - size + 1, size, np.uint64)
        for i in range(size):
            found = batches.mix(found + values[i : i + len(found)])
        return np.unique(found)


def sketches(elements: np.ndarray, owner: np.ndarray, count: int, size: int) -> np.ndarray:
    """`size` coordinates for each of `count` sets, given elements and the set that each belongs to. Every set has an element."""
    flat = np.full(count * size, _EMPTY, np.uint64)
    elements, owner = elements, owner.astype(np.int64)
    open_sets = np.arange(count)
    for turn in range(2 * size):
        x = batches.mix(elements ^ np.uint64((turn + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        value = (np.uint64(turn) << np.uint64(40)) | (x & np.uint64(0xFFFFFFFFFF))
        place = ((x >> np.uint64(40)) * np.uint64(size) >> np.uint64(24)).astype(np.int64) if turn < size else turn - size
        np.minimum.at(flat, owner * size + place, value)
        if turn % 4 == 0 or turn >= size:
            # only sets with an empty coordinate go on; later rounds could not change a full one
            still = (flat.reshape(count, size)[open_sets] == _EMPTY).any(axis=1)
            open_sets = open_sets[still]
            if not len(open_sets):
                break
            going = np.zeros(count, bool)
            going[open_sets] = True
            keep = going[owner]
            if not keep.all():
                elements, owner = elements[keep], owner[keep]
    return flat.reshape(count, size)


def _sketched(words: int, bands: int, height: int):
    size = bands * height
    schema = pa.schema(
        [("doc", pa.int64()), ("n_shingles", pa.int64()), ("one", pa.int64()), ("two", pa.int64()), ("bands", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64()))]
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Sets(words)
        for part in batches.slices(parts, most=batches.SLICE_BYTES // 2):
            found = [sets.of(t) for t in batches.raw(part)]
            counts = np.array([len(s) for s in found], np.int64)
            full = np.flatnonzero(counts)
            every = np.concatenate([found[i] for i in full]) if len(full) else np.zeros(0, np.uint64)
            owner = np.repeat(np.arange(len(full)), counts[full])
            made = sketches(every, owner, len(full), size) if len(full) else np.zeros((0, size), np.uint64)
            rows = made.reshape(len(full), bands, height)
            key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(full), bands))
            for r in range(height):
                key = batches.mix(key + rows[:, :, r])
            bit = (batches.mix(made) & np.uint64(1)).astype(np.uint8)
            bit = np.pad(bit, ((0, 0), (0, -size % 64)))
            packed = np.packbits(bit, axis=1).view(np.int64) if len(full) else np.zeros((0, 1), np.int64)
            sums = []
            for salt in (0x1234567, 0x89ABCDEF01):
                total = np.zeros(len(full), np.uint64)
                if len(full):
                    total = np.add.reduceat(batches.mix(every + np.uint64(salt)), np.cumsum(counts[full]) - counts[full])
                at = np.zeros(part.num_rows, np.uint64)
                at[full] = batches.mix(total ^ counts[full].astype(np.uint64))
                sums.append(at.view(np.int64))
            lists = {}
            for name, values in (("bands", key.astype(np.uint64).view(np.int64)), ("bits", packed)):
                width = np.zeros(part.num_rows, np.int64)
                width[full] = values.shape[1]
                lists[name] = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(width)]).astype(np.int32), values.ravel())
            yield batches.rows(schema, doc=part.column("doc"), n_shingles=counts, one=sums[0], two=sums[1], **lists)

    return run


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets have 100 * common >= percent * union."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _forest(ids: list[int], sets: list[np.ndarray], percent: int, loose: list[int], tied: list[int]) -> list[tuple[int, int]]:
    """Links of a spanning forest among the sets of one cell, where `loose` ones are compared with all; `tied` ones are connected already."""
    links: list[tuple[int, int]] = []
    if not loose or len(ids) < 2:
        return links
    above = list(range(len(ids)))
    for i in tied:
        above[i] = tied[0]

    def top(i: int) -> int:
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    sizes = np.array([len(s) for s in sets], np.int64)
    column = np.unique(np.concatenate(sets), return_inverse=True)[1]
    row = np.repeat(np.arange(len(sets)), sizes)
    often = np.bincount(column) > 1
    use = often[column]
    column, row = (np.cumsum(often) - 1)[column[use]], row[use]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    loose_at = np.array(loose)
    common = np.zeros((len(loose), len(sets)), np.float32)
    total = int(often.sum())
    for low in range(0, total, _COLUMNS):
        first, last = np.searchsorted(column, [low, low + _COLUMNS])
        part = np.zeros((len(sets), min(_COLUMNS, total - low)), np.float32)
        part[row[first:last], column[first:last] - low] = 1.0
        common += part[loose_at] @ part.T
    common = common.astype(np.int64)
    good = 100 * common >= percent * (sizes[loose_at][:, None] + sizes[None, :] - common)
    good[np.arange(len(loose)), loose_at] = False
    for i, j in zip(*np.nonzero(good)):
        a, b = top(int(loose_at[i])), top(int(j))
        if a != b:
            above[a] = b
            links.append((ids[loose_at[i]], ids[j]))
    return links


LINK = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("loose", pa.bool_()), ("text", pa.string())])
LINKS = "a long, b long, loose boolean, text string"
Row = tuple[int, int, bool, str | None]


@dataclass
class Cell:
    """Rows of one cell of a centre: ids, sets, marks and texts."""

    centre: int
    number: int
    ids: list[int] = field(default_factory=list)
    sets: list[np.ndarray] = field(default_factory=list)
    marks: list[bool] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)


def _cell_by_cell(words: int, answer: Callable[[Cell], list[Row]]):
    """Answers for rows that come cell by cell, as (centre, cell, doc, mark, text)."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Sets(words)
        now: Cell | None = None

        def done() -> pa.RecordBatch:
            rows = answer(now)
            return batches.rows(LINK, **{n: [r[k] for r in rows] for k, n in enumerate(LINK.names)})

        for batch in incoming:
            for centre, cell, doc, mark, text in zip(*(batch.column(c).to_pylist() for c in ("centre", "cell", "doc", "mark", "text"))):
                if now is None or (centre, cell) != (now.centre, now.number):
                    if now is not None:
                        yield done()
                    now = Cell(centre, cell)
                now.ids.append(doc)
                now.sets.append(sets.of(text.encode()))
                now.marks.append(mark)
                now.texts.append(text)
        if now is not None:
            yield done()

    return run


def _starred(percent: int):
    """Links of a block's members to the centre, and where the block is all of the group (mark) those among the rest.

    The members of larger groups come with their texts, loose where that text is not linked to the centre; the centre comes once.
    """

    def answer(cell: Cell) -> list[Row]:
        ids, sets = cell.ids, cell.sets
        at = ids.index(cell.centre)
        near = [i for i in range(len(ids)) if i != at and linked(sets[at], sets[i], percent)]
        tied = {at, *near}
        rest = [i for i in range(len(ids)) if i not in tied]
        if cell.marks[at]:
            among = _forest(ids, sets, percent, rest, [at, *near])
            return [(cell.centre, ids[i], False, None) for i in near] + [(a, b, False, None) for a, b in among]
        out = near if cell.number else [at, *near]
        return [(cell.centre, ids[i], False, cell.texts[i]) for i in out] + [(cell.centre, ids[i], True, cell.texts[i]) for i in rest]

    return answer


def _met(percent: int):
    """Links of the loose members (mark) of a cell to all in it."""

    def answer(cell: Cell) -> list[Row]:
        loose, tied = ([i for i, mark in enumerate(cell.marks) if mark == kind] for kind in (True, False))
        return [(a, b, False, None) for a, b in _forest(cell.ids, cell.sets, percent, loose, tied)]

    return answer


def _judged(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """(centre, doc, apart): in how many bits the two differ; a written table."""
    both = pairs.join(bits, "doc").join(bits.select(F.col("doc").alias("centre"), F.col("bits").alias("centre_bits")), "centre")
    apart = F.aggregate(F.zip_with("bits", "centre_bits", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return _written(both.select("centre", "doc", apart.alias("apart")), "members")


def _written(frame: DataFrame, label: str) -> DataFrame:
    folder = scratch(frame.sparkSession, label)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def _centred(placed: DataFrame) -> DataFrame:
    """(bucket, centre, doc) of the members but the smallest."""
    buckets = placed.groupBy("bucket").agg(F.min("doc").alias("centre"), F.count("*").alias("members")).where("members > 1").drop("members")
    return placed.join(buckets, "bucket").where("doc <> centre").select("bucket", "centre", "doc")


def _settle(ids: np.ndarray, bits: np.ndarray, far: int, edge: int) -> list[tuple[int, int]]:
    """(centre, doc) so that any two members whose bits differ in `edge` places at most have a centre in common, or one is the other's.

    A member that nobody is so close to is linked with nobody, and leaves without a pair.
    """
    order = np.argsort(ids, kind="stable")
    pairs: list[tuple[int, int]] = []
    while len(order) > 1:
        centre, order = order[0], order[1:]
        apart = np.bitwise_count(bits[order] ^ bits[centre]).sum(axis=1, dtype=np.int64)
        if apart.min() > edge:
            continue
        near = apart <= far
        pairs += [(int(ids[centre]), int(d)) for d in ids[order[near]] if d != ids[centre]]
        if near.all():
            break
        order = order[apart > far - edge]
    return pairs


def _rest(placed: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """(centre, doc) for what the rounds left of the buckets, by cells of at most two blocks of bits."""
    schema = pa.schema([("centre", pa.int64()), ("doc", pa.int64())])
    far, edge = far_for(percent), edge_for(percent)

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, own = None, [], []

        def done() -> pa.RecordBatch:
            pairs = _settle(np.array(ids, np.int64), np.array(own, np.int64).view(np.uint64), far, edge)
            return batches.rows(schema, centre=[c for c, _ in pairs], doc=[d for _, d in pairs])

        for batch in incoming:
            for bucket, cell, doc, marks in zip(*(batch.column(c).to_pylist() for c in ("bucket", "cell", "doc", "bits"))):
                if (bucket, cell) != now:
                    if now is not None:
                        yield done()
                    now, ids, own = (bucket, cell), [], []
                ids.append(doc)
                own.append(marks)
        if now is not None:
            yield done()

    full = _cells(placed, "bucket").join(bits, "doc").select("bucket", "cell", "doc", "bits")
    parts = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    arranged = full.repartition(parts, "bucket", "cell").sortWithinPartitions("bucket", "cell")
    return arranged.mapInArrow(run, "centre long, doc long")


def _cells(members: DataFrame, key: str) -> DataFrame:
    """(key, doc, cell): members of a key dealt to blocks by hash, and each block to its cells with every other block."""
    blocks = members.groupBy(key).agg(F.count("*").alias("n")).select(key, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(blocks, key).withColumn("own", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        key, "doc", (F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")).alias("cell")
    )


def candidates(known: DataFrame, percent: int) -> DataFrame:
    """(centre, doc): groups in which all pairs at the threshold meet that have a band in common."""
    far, edge = far_for(percent), edge_for(percent)
    bits = known.select("doc", "bits")
    placed = known.select("doc", F.explode("bands").alias("bucket"))
    judged = _judged(_centred(placed).select("centre", "doc").distinct(), bits)
    found = judged.where(F.col("apart") <= far).select("centre", "doc")
    for turn in range(ROUNDS):
        if not judged.where(F.col("apart") > far).limit(1).count():
            break
        going = judged.where(F.col("apart") > far - edge).groupBy("centre", "doc").agg(F.max(F.col("apart") > far).alias("away"))
        if turn:
            back = _centred(placed).join(going, ["centre", "doc"]).select("bucket", "doc", "away")
        else:  # the bands that both have, among them those whose centre the one is: few rows, while the buckets are many
            bands = known.select("doc", "bands")
            both = going.join(bands, "doc").join(bands.select(F.col("doc").alias("centre"), F.col("bands").alias("others")), "centre")
            back = both.select(F.explode(F.array_intersect("bands", "others")).alias("bucket"), "doc", "away")
        spread = back.groupBy("bucket", "doc").agg(F.max("away").alias("away"))
        # members that are all near to one centre have met there
        goes_on = spread.groupBy("bucket").agg(F.count("*").alias("members"), F.max("away").alias("any")).where("members > 1 AND any")
        placed = _written(spread.select("bucket", "doc").join(goes_on.select("bucket"), "bucket"), "left")
        if turn == ROUNDS - 1:
            more = _rest(placed, bits, percent)
        else:
            judged = _judged(_centred(placed).select("centre", "doc").distinct(), bits)
            more = judged.where(F.col("apart") <= far).select("centre", "doc")
        found = _written(found.unionByName(more).distinct(), "found")
    return found


def _stars(members: DataFrame) -> DataFrame:
    """(centre, doc, cell, mark): each member once, with the centre in each block; `mark` where the one block is the whole group."""
    blocks = members.groupBy("centre").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    mark = (F.col("blocks") == 1).alias("mark")
    dealt = members.join(blocks, "centre").select("centre", "doc", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("long").alias("cell"), mark)
    central = blocks.select("centre", F.col("centre").alias("doc"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("cell"), mark)
    return dealt.unionByName(central)


def _meetings(members: DataFrame) -> DataFrame:
    """(centre, cell, doc, mark, text) of (centre, doc, mark, text): loose members (mark) in cells with every block of their group, the
    others only with the loose ones, and nobody where no member is loose."""
    count = lambda of: F.ceil(F.count_if(of) / BLOCK)
    sizes = members.groupBy("centre").agg(count(F.col("mark")).alias("own"), count(~F.col("mark")).alias("others")).where("own > 0")
    spread = F.xxhash64("doc")
    block = F.when(F.col("mark"), F.pmod(spread, F.col("own"))).otherwise(F.col("own") + F.pmod(spread, F.greatest("others", F.lit(1))))
    last = F.when(F.col("mark"), F.col("own") + F.col("others")).otherwise(F.col("own")) - 1
    dealt = members.join(sized(sizes), "centre").withColumn("block", block)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    cell = F.least("block", "other") * (F.col("own") + F.col("others")) + F.greatest("block", "other")
    return dealt.select("centre", cell.alias("cell"), "doc", "mark", "text")


def links(docs: DataFrame, known: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): links that connect the classes of `known` sketches (one row per class, doc being its id) as all true links would."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compared(full: DataFrame, answer: Callable[[Cell], list[Row]]) -> DataFrame:
        arranged = full.repartition(parts, "centre", "cell").sortWithinPartitions("centre", "cell", "doc")
        return _written(arranged.mapInArrow(_cell_by_cell(words, answer), LINKS), "linked")

    # always by shuffle: what is compared grows with the texts, so it would outgrow a broadcast
    texts = spans.keyed(docs).select("doc", "text").hint("merge")
    stars = _stars(candidates(known, percent)).join(texts, "doc").select("centre", "cell", "doc", "mark", "text")
    first = compared(stars, _starred(percent))
    found = first.where("NOT loose").select("a", "b")
    if first.where("loose").isEmpty():
        return found
    # the texts of large groups are at hand, so those of the corpus need not be shuffled again
    members = first.where("text IS NOT NULL").select(F.col("a").alias("centre"), F.col("b").alias("doc"), F.col("loose").alias("mark"), "text")
    return found.unionByName(compared(_meetings(members), _met(percent)).select("a", "b"))


def groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): documents linked, directly or over others, by 100 * common >= percent * union.

    Sets are distinct shingles of `words` words in A-Z lower case; with fewer words the whole sequence is one shingle; NULL
    texts and texts without words have none, and are linked with nothing. `component_id` is the smallest id that is reachable,
    the own one included, and `kept` tells whether it is the own one. Rows with one id are one document, linked by any of its
    texts; a NULL id counts as smaller than all and stays NULL. Other columns are not looked at.
    """
    spark = docs.sparkSession
    bands = bands_for(percent)
    folder = scratch(spark, "sketches")
    spans.keyed(docs).select("doc", "text").mapInArrow(_sketched(words, bands, rows_for(percent)), SKETCH).write.parquet(folder)
    rows = spark.read.schema(SKETCH).parquet(folder)
    sets = rows.where("n_shingles > 0")
    classes = _written(sets.groupBy("one", "two").agg(F.min("doc").alias("class"), F.count("*").alias("members")), "classes")
    # by the id too: the rows of a class with very many copies go to many tasks
    known = sets.join(classes.select(F.col("class").alias("doc"), "one", "two"), ["doc", "one", "two"]).select("doc", "one", "two", "bands", "bits")
    found = links(docs, known.dropDuplicates(["doc", "one", "two"]), words, percent)
    # an id with several texts links the classes of its texts
    ends = [f(c).alias(n) for c in ("one", "two") for f, n in ((F.min, f"{c}_low"), (F.max, f"{c}_high"))]
    several = sets.groupBy("doc").agg(*ends).where("one_low <> one_high OR two_low <> two_high").select("doc")
    more = sets.join(several, "doc").select("doc", "one", "two").join(classes, ["one", "two"]).select(F.col("doc").alias("a"), F.col("class").alias("b"))
    reached = components(found.unionByName(more))
    joined = classes.join(reached.select(F.col("id").alias("class"), "component"), "class", "left")
    named = _written(joined.select("one", "two", "members", F.coalesce("component", "class").alias("component")), "named")
    # classes above this share of the rows are fewer than 1 / HOT_SHARE, so they can be broadcast
    large = named.where(F.col("members") > F.lit(rows.count() * HOT_SHARE)).drop("members")
    own = sets.select("doc", "n_shingles", "one", "two")
    of_large = own.join(F.broadcast(large), ["one", "two"])
    of_small = own.join(F.broadcast(large.select("one", "two")), ["one", "two"], "left_anti").join(named.drop("members"), ["one", "two"])
    bare = rows.where("n_shingles = 0").select("doc", "n_shingles", F.col("doc").alias("component"))
    whole = of_large.unionByName(of_small).drop("one", "two").unionByName(bare)
    back = lambda c: F.when(F.col(c) != spans.NO_ID, F.col(c))
    return whole.select(
        back("doc").alias("doc_id"), "n_shingles", back("component").alias("component_id"), (F.col("doc") == F.col("component")).alias("kept")
    )

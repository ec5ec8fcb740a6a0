"""SimHash near-duplicates through an inverted index of byte positions.

A fingerprint of 64 bits is eight bytes at eight positions. Two fingerprints that differ in at most three bits
differ in at most three bytes, so they share at least five positional bytes: pairs are found through shared bytes,
their shared bytes are tallied, pairs with fewer than five are dropped, and the rest is verified bit by bit.

A posting list of a single positional byte would hold 1/256 of everything. The index therefore holds the lists'
intersections: of any five positions, four are one of 14 fixed quadruples, so 14 lists per fingerprint, each keyed
by four bytes, contain every pair that shares five. A list with more than ``LONGEST`` fingerprints, as a large group
of near copies leaves, is intersected again: what is left of the fingerprint is cut into eight parts, of which five
must be equal, and so on, until the lists are short or hold at most the 256 values of the last eight bits.

For the wider similarity of the pipeline, 0.8 of the five-word shingles, texts get a fingerprint of 64 positional bytes
over word pairs; the same index holds triples of them, and the tally and the verification use measured bounds instead
of guaranteed ones, since no bound on differing bytes is guaranteed there. All pairs of a list are compared: first with
one member each, which makes components of large groups, then those of different components.

Plan: fingerprints in Arrow batches; equal ones fold to one node before anything is paired, so exact copies cost
nothing. Lists are counted before they are joined, and only lists with two or more members are.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.components import components
from marquee.llm.text import LOWER, UPPER, batches, merge_joins, small_batches, text_digest
from marquee.session import materialize

SHINGLE_WORDS = 3
HASH_SEED = 42
BITS = 64
MOST_BITS = 3
PARTS = 8
LEAST_SHARED = PARTS - MOST_BITS
LONGEST = 256
# For similar texts: bits, shared bytes and differing bits of wide fingerprints over word pairs. Of texts with a
# similarity of 0.8 nearly all share 18 of the 64 positional bytes and differ in 56 bits at most.
WIDE_WORDS = 2
WIDE_PARTS = 8
WIDE_LEAST_SHARED = 18
WIDE_MOST_BITS = 56
# Odd numbers that shuffle the positions before they are cut into triples; a text is in 21 lists for each.
ROUNDS = (1, 37, 11, 23)
LEADERS = 4
BLOCK_BYTES = 1 << 20  # a text is shingled in blocks of about this size

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


def _blocks(raw: bytes, width: int):
    """Words of a text in blocks; a block starts with the last ``width - 1`` words of the one before it."""
    tail: list[bytes] = []
    at = 0
    while at < len(raw):
        end = at + BLOCK_BYTES
        while end < len(raw) and raw[end] not in b" \t\n\v\f\r":
            end += 1
        words = tail + raw[at:end].translate(_FOLD).split()
        yield words
        tail = words[len(words) - (width - 1):] if len(words) >= width else words
        at = end


def _tally(hashes: np.ndarray) -> np.ndarray:
    """Ones per bit of big-endian 64-bit hashes; added in bytes first, which 255 rows cannot overflow."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    full = len(bits) // 255 * 255
    ones = bits[full:].sum(0, dtype=np.int64)
    if full:
        ones += bits[:full].reshape(-1, 255, BITS).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
    return ones


def _hashes(text: str | None, width: int):
    """Hashes of all shingles of a text, repeats included, block by block. A text with fewer words than a shingle is
    one shingle; without words there is none."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    digest, any_, few = xxhash.xxh64_digest, False, []
    for words in _blocks(raw, width):
        if len(words) < width:
            few = words
            continue
        any_ = True
        shingles = zip(*(words[i:] for i in range(width)), strict=False)
        yield np.frombuffer(b"".join([digest(b" ".join(s), HASH_SEED) for s in shingles]), ">u8")
    if few and not any_:
        yield np.frombuffer(digest(b" ".join(few), HASH_SEED), ">u8")


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """Majority of every bit over the hashes of all shingles as a signed 64-bit number; zero without words."""
    ones, n = np.zeros(BITS, dtype=np.int64), 0
    for hashes in _hashes(text, width):
        ones += _tally(hashes)
        n += len(hashes)
    return int(np.packbits(2 * ones > n).view(">i8")[0]) if n else 0


def _rehashed(hashes: np.ndarray, part: int) -> np.ndarray:
    """Another hash of the same shingles, for the further parts of a wide fingerprint."""
    x = hashes.astype(np.uint64) + np.uint64(part * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).astype(">u8")


def wide_fingerprint(text: str | None, width: int = WIDE_WORDS, parts: int = WIDE_PARTS) -> list[int]:
    """A fingerprint of ``parts`` times 64 bits, each part over another hash of the shingles."""
    ones, n = np.zeros((parts, BITS), dtype=np.int64), 0
    for hashes in _hashes(text, width):
        for part in range(parts):
            ones[part] += _tally(_rehashed(hashes, part))
        n += len(hashes)
    if not n:
        return [0] * parts
    return np.packbits(2 * ones > n, axis=1).view(">i8").ravel().tolist()


def fingerprints(docs: DataFrame, key: str = "doc_id", width: int = SHINGLE_WORDS, wide: bool = False) -> DataFrame:
    """(key, fp) of every row, with ``wide`` also the wide fingerprint and the text's digest; null texts count as empty."""
    more = [("wide", pa.list_(pa.int64())), ("digest", pa.binary())] if wide else []
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64()), *more])

    def run(parts):
        def rows():
            for part in parts:
                digests = part.column(2).to_pylist() if wide else [None] * len(part)
                for one, text, digest in zip(part.column(0).to_pylist(), part.column(1), digests, strict=True):
                    text = text.as_py()
                    yield (one, fingerprint(text, width), *([wide_fingerprint(text), digest] if wide else []))

        yield from batches(schema, rows())

    small_batches(docs)
    return docs.select(F.col(key).cast("long"), "text", *([text_digest(F.col("text"))] if wide else [])).mapInArrow(
        run, "key bigint, fp bigint" + (", wide array<bigint>, digest binary" if wide else "")
    )


def quadruples() -> list[tuple[int, ...]]:
    """14 quadruples of eight positions such that any five positions contain one of them.

    Split the positions into two halves of four. Five positions hold all of a half, or three of one and two of the
    other; three of four always contain a pair of any way to pair up the four. So: both halves, and for each of the
    three ways to pair up a half, its pairs with the pairs of the same way in the other half.
    """
    ways = [((0, 1), (2, 3)), ((0, 2), (1, 3)), ((0, 3), (1, 2))]
    mixed = [
        (*a, *(4 + x for x in b)) for way in ways for a, b in itertools.product(way, way)
    ]
    return [(0, 1, 2, 3), (4, 5, 6, 7), *mixed]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def refinements(mask: int) -> list[int]:
    """Masks that keep the bits of ``mask`` and four of the eight parts of the others."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    step = len(free) // PARTS
    parts = [sum(1 << i for i in free[p * step:(p + 1) * step]) for p in range(PARTS)]
    return [mask | sum(parts[p] for p in four) for four in quadruples()]


def _lists(nodes: DataFrame, masks: list[int]) -> DataFrame:
    """(mask, value, fp): the index entries of fingerprints under all ``masks``."""
    mask = F.explode(F.array(*[F.lit(_signed(m)).cast("long") for m in masks])).alias("mask")
    return nodes.select("fp", mask).select("mask", F.expr("fp & mask").alias("value"), "fp")


def _refined(entries: DataFrame, masks: list[int]) -> DataFrame:
    """The entries of too long lists, under the refinements of their masks."""
    finer = F.map_from_arrays(
        F.array(*[F.lit(_signed(m)).cast("long") for m in masks]),
        F.array(*[F.array(*[F.lit(_signed(f)).cast("long") for f in refinements(m)]) for m in masks]),
    )
    more = entries.select("fp", F.explode(F.element_at(finer, F.col("mask"))).alias("mask"))
    return more.select("mask", F.expr("fp & mask").alias("value"), "fp").distinct()


def links(nodes: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Pairs (u, v), u < v, of the distinct fingerprints ``fp`` that differ in at most three bits; all of them."""
    masks = refinements(0)
    entries = _lists(nodes, masks)
    found = None
    while True:
        sizes = entries.groupBy("mask", "value").agg(F.count("*").alias("n")).filter("n > 1")
        shared = materialize(entries.join(sizes, ["mask", "value"]), "shared-bytes")
        free = BITS - masks[0].bit_count()
        last = free <= PARTS
        short = shared if last else shared.filter(F.col("n") <= longest)
        left = short.select("mask", "value", F.col("fp").alias("u"))
        right = short.select("mask", "value", F.col("fp").alias("v"))
        pairs = left.join(right, ["mask", "value"]).filter("u < v").select("u", "v")
        tally = sum(
            F.expr(f"int((shiftrightunsigned(u ^ v, {8 * i}) & 255L) = 0)") for i in range(PARTS)
        )
        verified = pairs.filter((tally >= LEAST_SHARED) & (F.expr("bit_count(u ^ v)") <= MOST_BITS))
        found = verified if found is None else found.unionByName(verified)
        long = shared.filter(F.col("n") > longest)
        if last or long.isEmpty():
            return found.distinct()
        used = [row[0] for row in long.select("mask").distinct().collect()]  # at most one per mask of this level
        masks = [m & (1 << 64) - 1 for m in used]
        entries = _refined(long, masks)
        masks = [refinements(m)[0] for m in masks]


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", width: int = SHINGLE_WORDS, longest: int = LONGEST
) -> DataFrame:
    """(key, fp, component_id) of every row: the group of texts that links of at most three bits connect.

    ``component_id`` is the smallest key of the group, the row's own included; null keys are ignored unless a group
    has no other. Null texts and texts without words have fingerprint zero and form a group of their own with
    whatever lies near zero. Repeated rows fall into one group; other columns are ignored; no rows give no rows.
    """
    prints = materialize(fingerprints(docs, key, width), "fingerprints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("key").alias("low")), "fingerprint-nodes")
    roots = components(links(nodes.select("fp"), longest))
    grouped = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    lowest = grouped.groupBy("root").agg(F.min("low").alias("component_id"))
    of_print = grouped.join(lowest, "root").select("fp", "component_id")
    return prints.join(of_print, "fp").select(F.col("key").alias(key), "fp", "component_id")


def _triples(parts: int = WIDE_PARTS) -> list[tuple[int, int, int]]:
    """Triples of byte positions that key the lists of wide fingerprints: ``ROUNDS`` times all positions but one."""
    positions = range(8 * parts)
    rounds = [sorted(positions, key=lambda p: (p * odd % (8 * parts), p)) for odd in ROUNDS]
    return [tuple(r[i:i + 3]) for r in rounds for i in range(0, len(r) - 2, 3)]


def _index(nodes: DataFrame, *more: str) -> DataFrame:
    """(list, node, ...): the lists of wide fingerprints, by the value of each of the triples."""
    triples = F.array(*[F.struct(*[F.lit(x) for x in (n, *triple)]) for n, triple in enumerate(_triples())])
    byte = "(shiftrightunsigned(wide[cast({0} / 8 as int)], 8 * ({0} % 8)) & 255L)"
    key = " | ".join(["bigint(t.col1) << 24", *(f"{byte.format(f't.col{i}')} << {8 * (4 - i)}" for i in (2, 3, 4))])
    keyed = nodes.select("node", "wide", *more, triples.alias("triples"))
    return keyed.select(F.explode(F.expr(f"transform(triples, t -> {key})")).alias("list"), "node", *more)


def _similar(most: int, least_shared: int) -> Column:
    """Whether ``u_wide`` and ``v_wide`` differ in few bits and share enough positional bytes.

    Shifts gather every byte's bits in its lowest one, so the ones that are left count the bytes that differ.
    """
    flips = " + ".join(f"bit_count(u_wide[{i}] ^ v_wide[{i}])" for i in range(WIDE_PARTS))
    gathered = "zip_with(u_wide, v_wide, (x, y) -> x ^ y)"
    for step in (4, 2, 1):
        gathered = f"transform({gathered}, d -> d | shiftrightunsigned(d, {step}))"
    lowest = int("01" * 8, 16)
    differing = f"aggregate({gathered}, 0, (n, d) -> n + bit_count(d & {lowest}L))"
    return F.expr(f"{flips} <= {most}") & F.expr(f"{8 * WIDE_PARTS} - {differing} >= {least_shared}")


def leader_links(nodes: DataFrame, most: int = WIDE_MOST_BITS, least_shared: int = WIDE_LEAST_SHARED) -> DataFrame:
    """Links (u, v) of similar wide fingerprints with one member of each of their lists, from (node, wide).

    A list joins the fingerprints that agree in three positional bytes. Its members are compared with one of them, so a
    list costs its length; large groups of near copies, which share many lists, become one component by this alone. Lists
    of the same members name one of ``LEADERS`` leaders, so such a group gives that many links a member and not one per
    list. The other pairs of a list are left to ``crossing_links``.
    """
    entries = _index(nodes)
    leaders = (
        entries.groupBy("list").agg(F.count("*").alias("n"), F.expr(f"min_by(node, xxhash64(node, shiftright(list, 24) % {LEADERS}))").alias("leader"))
        .filter("n > 1").drop("n")
    )
    pairs = (
        entries.join(leaders, "list").filter("node <> leader")
        .select(F.least("node", "leader").alias("u"), F.greatest("node", "leader").alias("v")).distinct()
    )
    of = lambda name: nodes.select(F.col("node").alias(name), F.col("wide").alias(f"{name}_wide"))
    return pairs.join(of("u"), "u").join(of("v"), "v").filter(_similar(most, least_shared)).select("u", "v")


def crossing_links(
    nodes: DataFrame, longest: int = LONGEST, most: int = WIDE_MOST_BITS, least_shared: int = WIDE_LEAST_SHARED
) -> DataFrame:
    """Links (u, v) between components of all similar fingerprints that share a list, from (node, wide, root).

    All pairs of a list are compared but those within one component, which need no further link; a list of one component
    is not joined, nor is one of two members, which ``leader_links`` compared. A list of more than ``longest`` members
    is cut into blocks, and every two blocks meet in a group of their own. Returns the roots of each link's ends.
    """
    crossing = (
        _index(nodes, "root").groupBy("list")
        .agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
        .filter("n > 2 AND low < high").select("list", F.ceil(F.col("n") / longest).alias("blocks"))
    )
    members = (
        _index(nodes).join(crossing, "list").withColumn("block", F.expr("pmod(xxhash64(node, list), blocks)"))
        .join(nodes, "node")
    )
    side = lambda name: [F.col(c).alias(f"{name}_{c}") for c in ("node", "root", "wide")]
    left = members.select("list", F.col("block").alias("x"), F.expr("explode(sequence(block, blocks - 1))").alias("y"), *side("u"))
    right = members.select("list", F.expr("explode(sequence(0L, block))").alias("x"), F.col("block").alias("y"), *side("v"))
    other = F.expr("u_root <> v_root AND (x < y OR u_node < v_node)")
    met = left.withColumnsRenamed({c: f"u_{c}" for c in ("list", "x", "y")}).join(
        right, F.expr("u_list = list AND u_x = x AND u_y = y") & other & _similar(most, least_shared)
    )
    return met.select(F.least("u_root", "v_root").alias("u"), F.greatest("u_root", "v_root").alias("v")).distinct()


def similar_components(nodes: DataFrame, known: DataFrame | None = None, longest: int = LONGEST) -> DataFrame:
    """(node, wide, root) of every (node, wide): components of all similar pairs that share a list, and of the links
    ``known`` (u, v)."""
    first = leader_links(nodes)
    found = components(first.unionByName(known) if known else first)
    rooted = materialize(
        nodes.join(found, "node", "left").select("node", "wide", F.coalesce("root", "node").alias("root")), "rooted-nodes"
    )
    joined = components(crossing_links(rooted, longest)).select(F.col("node").alias("root"), F.col("root").alias("above"))
    return rooted.join(joined, "root", "left").select("node", "wide", F.coalesce("above", "root").alias("root"))


def _similar_nodes(prints: DataFrame, longest: int) -> DataFrame:
    """(fp, wide, low, root) of the distinct fingerprints; ``low`` is the first (last, key, digest) of their rows, null
    keys last."""
    with merge_joins(prints.sparkSession):
        return _rooted_prints(prints, longest)


def _rooted_prints(prints: DataFrame, longest: int) -> DataFrame:
    nodes = materialize(
        prints.groupBy("fp", "wide").agg(F.min(F.struct(F.col("key").isNull().alias("last"), "key", "digest")).alias("low"))
        .withColumn("node", F.monotonically_increasing_id()),
        "wide-nodes",
    )
    of_print = materialize(nodes.groupBy("fp").agg(F.min("node").alias("node")), "print-nodes")
    close = links(of_print.select("fp"), longest)
    name = lambda side: of_print.select(F.col("fp").alias(side), F.col("node").alias(f"{side}_node"))
    narrow = close.join(name("u"), "u").join(name("v"), "v").select(F.col("u_node").alias("u"), F.col("v_node").alias("v"))
    equal = nodes.select("fp", F.col("node").alias("v")).join(of_print, "fp").filter("v <> node").select(F.col("node").alias("u"), "v")
    roots = similar_components(nodes.select("node", "wide"), narrow.unionByName(equal), longest).select("node", "root")
    return materialize(nodes.join(roots, "node").select("fp", "wide", "low", "root"), "rooted-prints")


def similar_groups(docs: DataFrame, key: str = "doc_id", longest: int = LONGEST) -> DataFrame:
    """(key, group) of every row: texts that share about 0.8 of their five-word shingles or more, or whose narrow
    fingerprints differ in at most three bits, and what these links connect.

    Three bits of 64 find texts that are all but equal. For the similarity a wide fingerprint is compared: texts with a
    similarity of 0.8 differ in about a tenth of 512 bits over word pairs (measured in README). The group is its
    smallest key, null only without any; empty and null texts form one group.
    """
    prints = materialize(fingerprints(docs, key, wide=True), "wide-fingerprints")
    grouped = _similar_nodes(prints, longest)
    lowest = grouped.groupBy("root").agg(F.min("low")["key"].alias("group"))
    of_node = grouped.join(lowest, "root").select("fp", "wide", "group")
    return prints.join(of_node, ["fp", "wide"]).select(F.col("key").alias(key), "group")


def representatives(docs: DataFrame, key: str = "doc_id", longest: int = LONGEST) -> DataFrame:
    """One row of each group of ``similar_groups``, with the columns of ``docs``.

    It is the row with the smallest key, one without a key only if the group has no other, and of those the one with
    the smallest digest of its text. Keys need not be unique: texts are grouped by themselves, whatever their key. Of
    rows that share key and text the one with the smallest hash of all columns stays.
    """
    prints = materialize(fingerprints(docs, key, wide=True), "wide-fingerprints")
    lowest = _similar_nodes(prints, longest).groupBy("root").agg(F.min("low").alias("low"))
    kept = lowest.select(F.col("low.key").alias("_kept"), F.col("low.digest").alias("_digest"))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), text_digest(docs["text"]).alias("_text"))
    chosen = rows.join(kept, F.col("_row")[key].eqNullSafe(F.col("_kept")) & (F.col("_text") == F.col("_digest")))
    one = chosen.groupBy("_kept", "_digest").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row"))
    return one.select("_row.*")

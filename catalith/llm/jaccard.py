"""Jaccard self-join of documents on word shingles, with skipping by set relations.

Documents with one set are one class. Classes that are alike are linked to a leader first, found by equal minimum hashes. Then every class posts the
front of its tokens, in one order for all sets, to an index; pairs meet at a token that both hold in front. Skipped are: tokens of one
component only; blocks of a token's list whose sizes or positions cannot reach the threshold; and pairs whose token parities differ by too
much. Classes that the pairs left open hold together are a group. There each set is taken as its differences to a leader, and a pair's answer is
derived from the leader's and the two differences, all out of whole texts. A group's links leave as one edge per class.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalith.llm.common import components, discard, finished_groups, list_column, release, run_pairs, small_batches, stored, values, widened

#: Odd multipliers that mix the hashes of a shingle's words, and those that permute tokens for the minimum hashes.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
PERMUTE = np.array([0x1, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


@dataclass(frozen=True)
class JaccardConfig:
    """Two sets link when ``per`` * intersection >= ``share`` * union. ``words`` make a shingle.

    ``front`` is the part of the token space in which common tokens are put behind rare ones; a token is common when more than ``common`` classes hold it.
    Rows of an index list beyond ``block`` are dealt in blocks, and groups to compare in parts of ``members``. Tokens are looked for in other sets in ``passes``, a
    share of them each. ``front``, ``common``, ``block``, ``members``, ``passes`` and ``memory`` (words a worker remembers) change the work, never the result.
    """

    words: int = 5
    share: int = 80
    per: int = 100
    front: float = 0.25
    common: int = 16
    rounds: int = 4
    block: int = 8192
    members: int = 2048
    passes: int = 4
    memory: int = 1 << 20


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = _WordHashes()


def shingle_sets(texts: pa.Array, config: JaccardConfig) -> list[np.ndarray]:
    """Sorted distinct 63-bit hashes of each text's shingles: A-Z lower-cased, words split at ASCII white space.

    Words are split and told apart for the whole column, so each distinct word of it is hashed once, and shingles are mixed over all texts at once; those that would
    reach into the next text are left out.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = split.flatten()
    some = pc.greater(pc.binary_length(flat), 0)  # a text that starts or ends with white space gives empty words
    before = np.r_[0, np.cumsum(some.to_numpy(zero_copy_only=False))]
    bounds = before[np.r_[0, np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))]]
    coded = flat.filter(some).dictionary_encode()
    if len(_words) > config.memory:
        _words.clear()
    distinct = coded.dictionary.cast(pa.large_string())
    ends = np.frombuffer(distinct.buffers()[1], np.int64)[distinct.offset : distinct.offset + len(distinct) + 1].tolist() if len(distinct) else [0]
    raw = distinct.buffers()[2].to_pybytes() if len(distinct) else b""
    h = np.fromiter((_words[raw[a:b]] for a, b in zip(ends[:-1], ends[1:], strict=True)), np.uint64, len(distinct))[coded.indices.to_numpy()]
    size = max(0, len(h) - config.words + 1)
    mixed = np.zeros(size, np.uint64)
    for k in range(config.words):
        mixed += (h[k : k + size] * MIX[k % len(MIX)]) ^ np.uint64(k)
        mixed *= MIX[-1 - k % len(MIX)]
        mixed ^= mixed >> np.uint64(29)
    mixed ^= mixed >> np.uint64(32)
    mixed *= MIX[0]
    mixed ^= mixed >> np.uint64(29)
    mixed >>= np.uint64(1)
    out = []
    for i, (start, end) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        n = end - start
        if 0 < n < config.words:
            words = texts[i].as_py().encode().lower().split()
            out.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=n) >> 1], np.uint64))
        else:
            own = np.sort(mixed[start : end - config.words + 1]) if n else mixed[:0]
            out.append(own[np.r_[True, own[1:] != own[:-1]]] if n else own)
    return out


def shingle_set(text: str | None, config: JaccardConfig) -> np.ndarray:
    """The shingles of one text, see :func:`shingle_sets`."""
    return shingle_sets(pa.array([text], pa.string()), config)[0]


def _front(n: int, config: JaccardConfig) -> int:
    """How many tokens, in the common order, a set of n must post so that any set that links with it has one of them in front as well."""
    return n - -(-config.share * n // config.per) + 1


def parities(tokens: np.ndarray) -> bytes:
    """Which of the low bits' values an odd number of tokens has, as bits; a bit a token or more, by powers of two from 1024 to 8192.

    Where the parities of two sets differ, so do the sets: the differing bits are never more than the tokens by which the sets differ.
    """
    width = min(8192, max(1024, 1 << (len(tokens) - 1).bit_length()))
    odd = np.bincount((tokens & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def parity_rows(raw: list[bytes]) -> np.ndarray:
    """Parities as rows of 64-bit words, all folded to the narrowest among them: a bit of a narrower one is the parity of the bits that fall on it."""
    least = min(map(len, raw))
    out = np.zeros((len(raw), least // 8), np.uint64)
    for width in set(map(len, raw)):
        rows = [i for i, r in enumerate(raw) if len(r) == width]
        words = np.frombuffer(b"".join([raw[i] for i in rows]), "<u8").reshape(len(rows), width // least, least // 8)
        out[rows] = np.bitwise_xor.reduce(words, axis=1)
    return out


def sketches(docs: DataFrame, config: JaccardConfig, key: str, text: str) -> DataFrame:
    """Per row: key, n (size of its set), digest of the set, odd (its parities), mins (minimum hashes), below (tokens in the front part of the space), tokens (to post)."""
    schema = widened(docs.select(key).schema, "n bigint, digest binary, odd binary, mins array<bigint>, below bigint, tokens array<bigint>")
    cut = np.uint64(int(config.front * (1 << 63)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            rows = shingle_sets(batch.column(batch.schema.get_field_index(text)), config)
            below = [int(np.searchsorted(s, cut)) for s in rows]
            posts = [s[: max(b, _front(len(s), config))] if len(s) else s for s, b in zip(rows, below, strict=True)]
            mins = [(s[:, None] * PERMUTE[None, :]).min(0).view(np.int64) if len(s) else np.zeros(0, np.int64) for s in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key), pa.array([len(s) for s in rows], pa.int64()),
                    pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in rows], pa.binary()),
                    pa.array([parities(s) if len(s) else None for s in rows], pa.binary()), list_column(mins), pa.array(below, pa.int64()), list_column(posts),
                ],
                names=schema.names,
            )

    return docs.select(key, text).mapInArrow(run, schema)


def _links(config: JaccardConfig, both: Column, a: Column, b: Column) -> Column:
    return config.per * both >= config.share * (a + b - both)


def _sizes_fit(config: JaccardConfig, a: Column, b: Column) -> Column:
    return (config.per * F.least(a, b) >= config.share * F.greatest(a, b))


def leader_candidates(classes: DataFrame, comps: DataFrame | None, draw: int, config: JaccardConfig) -> DataFrame:
    """(a, b): class b and a class a, of another component, that has one of b's minimum hashes.

    The first draw takes the smallest class of each hash, later ones the smallest by a hash of its own; a minimum is aggregated, never a group gathered.
    """
    known = classes.select("sid", "n", "mins", F.col("sid").alias("comp"))
    if comps is not None:
        known = known.drop("comp").join(comps.withColumnRenamed("node", "sid"), "sid", "left").select("sid", "n", "mins", F.coalesce("component", "sid").alias("comp"))
    hashes = known.select("sid", "n", "comp", F.posexplode("mins").alias("k", "m"))
    order = F.xxhash64(F.lit(draw), "sid") if draw else F.col("sid")
    least = hashes.groupBy("k", "m").agg(
        F.min(F.struct(order.alias("order"), "sid", "n", "comp")).alias("lead"), F.min("comp").alias("c0"), F.max("comp").alias("c1")
    ).where("c0 <> c1")
    joined = hashes.join(least, ["k", "m"]).where((F.col("comp") != F.col("lead.comp")) & _sizes_fit(config, F.col("n"), F.col("lead.n")))
    return joined.select(F.least("lead.sid", "sid").alias("a"), F.greatest("lead.sid", "sid").alias("b")).distinct()


def compare_texts(pairs: DataFrame, texts: DataFrame, config: JaccardConfig) -> DataFrame:
    """``pairs`` (a, b) with ``na``, ``nb``, ``both`` (size of the intersection), out of whole ``texts`` (sid, text).

    A side's text comes with each pair; pairs arrive sorted by ``a``, whose set a worker makes once for a run of pairs.
    """
    left = texts.select(F.col("sid").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("sid").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple[int | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        for batch in small_batches(batches, "text_b"):
            rows = []
            left, right = values(batch, "a"), shingle_sets(batch.column(3), config)
            first = [i for i, a in enumerate(left) if a != (left[i - 1] if i else kept[0])]
            sets = dict(zip(first, each_set(batch.column(2), first, config), strict=True))
            for i, (a, b, y) in enumerate(zip(left, values(batch, "b"), right, strict=True)):
                kept = (a, sets[i]) if i in sets else kept
                rows.append((a, b, len(kept[1]), len(y), len(np.intersect1d(kept[1], y, assume_unique=True))))
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(5)], names=["a", "b", "na", "nb", "both"])

    return joined.mapInArrow(run, "a bigint, b bigint, na bigint, nb bigint, both bigint")


def each_set(texts: pa.Array, at: list[int], config: JaccardConfig, most: int = 8 << 20) -> Iterator[np.ndarray]:
    """Sets of the texts at the places ``at``, made for about ``most`` bytes of text at once."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)[at]) if at else np.zeros(0, np.int64)
    start = 0
    while start < len(at):
        end = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + most, "right")))
        yield from shingle_sets(texts.take(pa.array(at[start:end])), config)
        start = end


def texts_of(docs: DataFrame, sids: DataFrame, classes: DataFrame, key: str, text: str) -> DataFrame:
    """(sid, text) of the classes ``sids``: the text of each class's representative row, found by its key and its text's digest."""
    wanted = classes.join(sids.select("sid").distinct(), "sid", "left_semi").select("sid", F.col("low").alias("_key"), "text_digest")
    rows = docs.select(F.col(key).alias("_k"), F.col(text).alias("text")).join(wanted, F.col("_k") == F.col("_key"))
    rows = rows.where(F.xxhash64("text") == F.col("text_digest")).select("sid", "text")
    return stored(rows.dropDuplicates(["sid"]), "texts")


def shared_posts(classes: DataFrame, config: JaccardConfig) -> list[DataFrame]:
    """Posts (token, sid, pos, common) whose token classes of more than one component hold: a stored table for each of ``passes`` shares of the tokens.

    Counts per token are aggregated before they are shuffled and joined back, so no task holds the list of a token. Most tokens are in one set only; a pass
    shuffles its share of them and lets go of it before the next one starts, so never all posts are on disk at once.
    """
    parts = []
    for part in range(config.passes):
        own = F.pmod("token", F.lit(config.passes)) == part
        counted = classes.select("comp", F.explode("tokens").alias("token")).where(own).groupBy("token")
        shared = counted.agg(F.count("*").alias("df"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1")
        posts = classes.select("sid", F.posexplode("tokens").alias("pos", "token")).where(own)
        held = posts.join(shared.select("token", (F.col("df") > config.common).alias("common")), "token")
        parts.append(stored(held.select("token", "sid", "pos", "common"), "posts"))
        del counted, shared, posts, held
        release()
    return parts


def front_entries(classes: DataFrame, posts: DataFrame, config: JaccardConfig) -> DataFrame:
    """Entries (token, sid, comp, n, place, common) of the index: tokens in front that classes of more than one component hold, out of their ``posts``.

    Order of tokens: the front part of the space before the rest; inside it common tokens last; then by hash.
    """
    held = posts.join(classes.select("sid", "comp", "n", "below"), "sid")
    behind = F.col("common") & (F.col("pos") < F.col("below"))
    rows = held.withColumn("behind", behind.cast("int"))
    whole = Window.partitionBy("sid")
    so_far = whole.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("behind").over(so_far), F.lit(0))).withColumn("all", F.sum("behind").over(whole))
    place = F.when(F.col("behind") == 1, F.col("below") - F.col("all") + F.col("before")).when(
        F.col("pos") < F.col("below"), F.col("pos") - F.col("before")).otherwise(F.col("pos"))
    front = F.col("n") - F.ceil(config.share * F.col("n") / config.per) + 1
    return rows.select("token", "sid", "comp", "n", place.cast("long").alias("place"), "common").where(F.col("place") < front)


def index_blocks(entries: DataFrame, config: JaccardConfig) -> DataFrame:
    """Entries dealt to (token, block_a, block_b): any two entries of a token that may make a pair meet in one group of at most about two blocks.

    At the first token that two linked sets share, their places add up to no more than what they differ by; so one place at least is near. A short list is one
    group. A long one lies in blocks by size and by near or far place, cut further by a hash; an entry goes to its block's pairs with the blocks that
    it can reach, and skips all others: those of a size too far off, and far ones for far entries.
    """
    ratio = config.per / config.share
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(ratio)) + 1e-9)
    # Half of what a set and a partner of the greatest size may differ by.
    reach = F.col("n") * (1 + ratio) * (config.per - config.share) / (config.per + config.share) / 2
    rows = entries.withColumn("near", F.col("place") <= reach + 1).withColumn("kind", (2 * band + F.col("near").cast("int")).cast("long"))
    counts = rows.groupBy("token", "kind").agg(F.count("*").alias("held"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    cuts = F.ceil(F.col("held") / config.block).cast("long")
    lists = counts.groupBy("token").agg(
        F.sum("held").alias("held"), F.min("c0").alias("c0"), F.max("c1").alias("c1"), F.map_from_entries(F.collect_list(F.struct("kind", cuts.alias("cuts")))).alias("cuts")
    ).where("c0 <> c1").select("token", (F.col("held") > config.block).alias("long"), "cuts")
    rows = rows.join(lists, "token")
    kind = F.col("kind")
    met = F.filter(F.map_keys("cuts"), lambda k: (F.abs(F.floor(k / 2) - F.floor(kind / 2)) <= 1) & ((k % 2 == 1) | (kind % 2 == 1)))
    own = kind * (1 << 32) + F.pmod(F.xxhash64("sid"), F.element_at("cuts", kind))
    blocks = F.flatten(F.transform(met, lambda k: F.transform(F.sequence(F.lit(0).cast("long"), F.element_at("cuts", k) - 1), lambda c: k * (1 << 32) + c)))
    none = F.lit(-1).cast("long")
    rows = rows.withColumn("own", F.when(F.col("long"), own).otherwise(none))
    rows = rows.withColumn("other", F.explode(F.when(F.col("long"), blocks).otherwise(F.array(none)))).drop("long", "cuts", "kind")
    return rows.withColumn("block_a", F.least("own", "other")).withColumn("block_b", F.greatest("own", "other")).drop("other", "common")


def open_groups(blocks: DataFrame, odd: DataFrame, config: JaccardConfig) -> DataFrame:
    """(group, sid): classes that pairs left open hold together; every pair that may link, and whose classes are of different components, is in a group.

    Pairs are made and tried inside the workers: those that meet at a token and whose sizes, places and parities (``odd``: sid, odd) allow a link are open. What
    leaves a worker is not the pairs but who is joined by them, a row per class; a group of more than ``members`` classes goes out as all pairs of its parts. The
    same classes joined at several tokens are one group, so it is compared once.
    """
    rows = blocks.join(odd, "sid").repartition("token", "block_a", "block_b").sortWithinPartitions("token", "block_a", "block_b", "n", "sid")
    share, per = config.share, config.per

    def open_pairs(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        sid, comp, n, place, own, near = (t[c].to_numpy(zero_copy_only=False) for c in ("sid", "comp", "n", "place", "own", "near"))
        keys = np.stack([t[c].to_numpy() for c in ("token", "block_a", "block_b")], 1)
        two = keys[:, 1] != keys[:, 2]
        odd = t["odd"].to_pylist()
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
        words = parity_rows(odd)
        wide = np.fromiter((len(v) > words.shape[1] * 8 for v in odd), bool, len(odd))
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, j in run_pairs(starts, np.r_[starts[1:], len(sid)], 200_000):
            room = n[i] + n[j] - 2 * -(-share * (n[i] + n[j]) // (share + per))
            small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
            fits = (comp[i] != comp[j]) & (near[i] | near[j]) & (per * small >= share * large) & (place[i] + place[j] <= room) & (~two[i] | (own[i] != own[j]))
            i, j, room = i[fits], j[fits], room[fits]
            close = np.bitwise_count(words[i] ^ words[j]).sum(1, dtype=np.int64) <= room
            i, j, room = i[close], j[close], room[close]
            for k in np.flatnonzero(wide[i] & wide[j]):
                both = parity_rows([odd[i[k]], odd[j[k]]])
                close_too = np.bitwise_count(both[0] ^ both[1]).sum() <= room[k]
                if not close_too:
                    i[k] = j[k]
            left.append(i[i != j])
            right.append(j[i != j])
        return np.concatenate(left), np.concatenate(right)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for t in finished_groups(batches, ("token", "block_a", "block_b")):
            i, j = open_pairs(t)
            if not len(i):
                continue
            if len(seen) > 100_000:
                seen.clear()
            groups, sids = [], []
            for members in _clusters(t["sid"].to_numpy(), i, j):
                parts = np.array_split(members, -(-len(members) // config.members))
                for a, one in enumerate(parts):
                    for other in parts[a + 1 :] or ([one] if len(parts) == 1 else []):
                        both = one if other is one else np.concatenate([one, other])
                        name = xxhash.xxh3_64_intdigest(both.tobytes()) >> 1
                        if name not in seen:
                            seen.add(name)
                            groups.append(np.full(len(both), name, np.int64))
                            sids.append(both)
            if groups:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in (groups, sids)], names=["group", "sid"])

    return rows.mapInArrow(run, "group bigint, sid bigint").distinct()


def _joined(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row that each of ``n`` rows is joined to by pairs."""
    label = np.arange(n)
    while True:
        before, low = label.copy(), np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            return label


def _clusters(sid: np.ndarray, i: np.ndarray, j: np.ndarray) -> Iterator[np.ndarray]:
    """Sorted distinct sids of each set of rows that pairs join."""
    label = _joined(len(sid), i, j)
    held = np.unique(np.concatenate([i, j]))
    order = held[np.argsort(label[held], kind="stable")]
    cuts = np.flatnonzero(np.diff(label[order])) + 1
    for rows in np.split(order, cuts):
        yield np.unique(sid[rows])


class _Group:
    """Classes of a group by what sets them apart from its first class, the leader: (tokens of the leader that they lack, tokens that they have beyond it).

    With ``L`` the leader's set, a pair's intersection is |L| - |L - B| - |L - C| + the tokens that the two differences share: what the leader's set answers for
    both is not looked at again.
    """

    def __init__(self, leader: np.ndarray) -> None:
        self.leader, self.sids, self.sizes, self.lacks, self.apart = leader, [], [], [], []

    def add(self, sid: int, tokens: np.ndarray) -> None:
        apart = np.setxor1d(self.leader, tokens, assume_unique=True)
        self.sids.append(sid)
        self.sizes.append(len(tokens))
        self.lacks.append((len(self.leader) + len(apart) - len(tokens)) // 2)
        self.apart.append(apart)

    def edges(self, config: JaccardConfig) -> tuple[list[int], list[int]]:
        """One edge for each class that links, to the first class that links join it to."""
        m = len(self.sids)
        sizes, lacks = np.array(self.sizes), np.array(self.lacks)
        flat = np.concatenate(self.apart) if m else np.zeros(0, np.uint64)
        _, token = np.unique(flat, return_inverse=True)
        owner = np.repeat(np.arange(m), [len(v) for v in self.apart])
        order = np.argsort(token, kind="stable")
        lists = np.searchsorted(token[order], np.arange(token.max(initial=-1) + 2))
        ends = np.cumsum([0, *[len(v) for v in self.apart]])
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for row in range(m - 1):
            own = token[ends[row] : ends[row + 1]]
            from_, count = lists[own], lists[own + 1] - lists[own]
            at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(from_, count)
            shared = np.bincount(owner[order[at]], minlength=m)
            both = len(self.leader) - lacks[row] - lacks + shared
            linked = np.flatnonzero(config.per * both >= config.share * (sizes[row] + sizes - both))
            linked = linked[linked > row]
            left.append(np.full(len(linked), row))
            right.append(linked)
        i, j = np.concatenate(left), np.concatenate(right)
        label = _joined(m, i, j)
        held = np.flatnonzero(label != np.arange(m))
        sids = np.array(self.sids, np.int64)
        return sids[label[held]].tolist(), sids[held].tolist()


def group_links(groups: DataFrame, texts: DataFrame, config: JaccardConfig) -> DataFrame:
    """(a, b): edges that join what links inside each of ``groups`` (group, sid), out of whole ``texts`` (sid, text); one per class and group at most.

    A worker reads a group class by class and keeps differences to the leader only, never all texts.
    """
    rows = groups.join(texts, "sid").select("group", "sid", "text").repartition("group").sortWithinPartitions("group", "sid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, group = None, None

        def finished() -> pa.RecordBatch:
            a, b = group.edges(config)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in small_batches(batches, "text"):
            for g, sid, tokens in zip(values(batch, "group"), values(batch, "sid"), shingle_sets(batch.column(2), config), strict=True):
                if g != name:
                    if group is not None:
                        yield finished()
                    name, group = g, _Group(tokens)
                group.add(sid, tokens)
        if group is not None:
            yield finished()

    return rows.mapInArrow(run, "a bigint, b bigint")


def similar_documents(docs: DataFrame, config: JaccardConfig = JaccardConfig(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id (the smallest key reachable by links, its own included).

    NULL or empty texts have an empty set and link with nothing. A NULL key keeps its row with a NULL component and links with nothing. Rows that repeat a key
    are one node: their sets' links are all its own. Other columns are not read. An empty table gives an empty result.
    """
    docs = docs.select(key, text)
    made = stored(_sketched(docs.withColumn("_digest", F.xxhash64(text)), config, key, text), "sketches")
    sets = made.where(F.col("n") > 0).where(F.col(key).isNotNull())
    least = F.min(F.struct(F.col(key).alias("low"), "text_digest", "n", "below", "odd", "mins", "tokens")).alias("least")
    classes = sets.groupBy("digest").agg(least).select("digest", "least.*").withColumn("sid", F.monotonically_increasing_id())
    classes = stored(classes, "classes")
    rows = stored(made.select(key, F.col("n").alias("n_shingles"), "digest"), "rows")
    discard(made)
    release()

    # Alike classes and their leaders. Later draws join what the first left apart: groups whose members link with each other but not with one leader.
    same_key = rows.where("n_shingles > 0").select(key, "digest").distinct().join(classes.select("digest", "sid"), "digest")
    first = same_key.groupBy(key).agg(F.min("sid").alias("a"), F.max("sid").alias("z")).where("a <> z").select(key, "a")
    links = same_key.join(first, key).select("a", F.col("sid").alias("b"))
    comps, answered = None, []
    for draw in range(config.rounds):
        pairs = stored(leader_candidates(classes, comps, draw, config), "leader-pairs")
        release()
        texts = texts_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("sid")), classes, key, text)
        release()
        answered.append(stored(compare_texts(pairs, texts, config), "leader-answers"))
        discard(pairs, texts)
        release()
        stars = answered[-1].where(_links(config, F.col("both"), F.col("na"), F.col("nb")))
        if draw and stars.isEmpty():
            break
        links = links.unionByName(stars.select("a", "b"))
        comps = stored(components(links), "components")
    release()

    # Pairs that the index brings together. Classes are written again with their components: each pass over their tokens reads them twice, in place of as many joins.
    known = classes.drop("mins").join(comps.withColumnRenamed("node", "sid"), "sid", "left").withColumn("comp", F.coalesce("component", "sid")).drop("component")
    known = stored(known, "known-classes")
    discard(classes)
    release()
    classes = known
    posts = shared_posts(classes, config)
    entries = stored(front_entries(classes, reduce(DataFrame.unionByName, posts), config), "entries")
    discard(*posts)
    release()
    met = stored(open_groups(index_blocks(entries, config), classes.select("sid", "odd"), config), "open-groups")
    discard(entries)
    release()
    texts = texts_of(docs, met, classes, key, text)
    release()
    more = stored(group_links(met, texts, config), "group-links")
    final = stored(_contracted(more, comps), "joined")
    discard(met, texts)
    release()

    # Every row's component by its class.
    ids = classes.select("digest", "low", "comp")
    ids = ids.join(final.select(F.col("node").alias("comp"), "component"), "comp", "left").select("digest", "low", F.coalesce("component", "comp").alias("comp"))
    ids = stored(ids, "class-components")
    lowest = ids.groupBy("comp").agg(F.min("low").alias("component_id"))
    labels = stored(ids.join(lowest, "comp").select(F.col("digest").alias("_digest"), "component_id"), "labels")
    result = rows.join(labels, (F.col("digest") == F.col("_digest")) & F.col(key).isNotNull(), "left")
    result = stored(result.select(key, "n_shingles", F.coalesce("component_id", F.col(key)).alias("component_id")), "similar")
    discard(rows, classes, *answered, comps, more, final, ids, labels)
    return result


def _sketched(rows: DataFrame, config: JaccardConfig, key: str, text: str) -> DataFrame:
    made = sketches(rows.withColumn("_pair", F.struct(F.col(key).alias("key"), F.col("_digest").alias("text_digest"))).select("_pair", text), config, "_pair", text)
    return made.select(F.col("_pair.key").alias(key), F.col("_pair.text_digest").alias("text_digest"), "n", "digest", "odd", "mins", "below", "tokens")


def _contracted(links: DataFrame, comps: DataFrame) -> DataFrame:
    """Components of components: links between classes, each class replaced by its component."""
    return components(_ends(links.select("a", "b"), comps).select(F.col("ca").alias("a"), F.col("cb").alias("b")))


def _ends(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    side = lambda s: comps.select(F.col("node").alias(s), F.col("component").alias(f"of_{s}"))
    both = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return both.select("a", "b", F.coalesce("of_a", "a").alias("ca"), F.coalesce("of_b", "b").alias("cb"))

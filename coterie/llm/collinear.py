"""Fuzzy passages that repeat across documents, by chaining shared word seeds."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coterie.llm.buffers import (
    NOT_SPACE,
    TO_LOWER,
    SpanHash,
    byte_view,
    mixed,
    pieces,
    ranges,
    window_hash,
    words,
)
from coterie.llm.exchange import (
    FLUSH_BYTES,
    NO_ID,
    ROWS,
    bucket_count,
    bucket_of,
    bucket_of_ids,
    by_bucket,
    keyed,
    rows_batch,
    text_blocks,
    texts_by_bucket,
    unpack,
)
from coterie.operators.lineage import cut

SEED_WORDS = 5
WINDOW = 4
LEAST_WORDS = 50
PERCENT = 75
GAP_COST = 0.02
LEAST_SEEDS = 2
MARGIN = 60
EDGE_WORDS = 60
ORIGIN = 1 << 31
HUB_CELLS = 1 << 18
DROP = 8
END_GAIN = 3
HOT_PLACES = 64
SEED_BUCKET_BYTES = 16 << 20

SEED, MATCH, MARK, LONG, EDGE_SEED, EDGE = range(6)
SEED_TYPES = [("seed", "u8"), ("doc_id", "i8"), ("version", "u4"), ("pos", "u4")]
MATCH_TYPES = [
    ("doc_id", "i8"), ("version", "u4"), ("pos", "u4"), ("hub", "i8"), ("hub_version", "u4"),
    ("hub_pos", "u4"),
]
MARK_TYPES = [("doc_id", "i8"), ("version", "u4"), ("pos", "u4")]


def word_hashes(data, offsets, hasher: SpanHash):
    """(hash of each word in lower case, bounds of the rows)."""
    data = TO_LOWER[data]
    starts, ends, bounds = words(data, offsets, NOT_SPACE)
    hasher.load(data)
    return hasher(starts, ends), bounds


def minimizers(hashes: np.ndarray, bounds: np.ndarray, width: int, window: int):
    """(seed, row, place in the row): the least of each ``window`` consecutive word runs.

    The same ``width + window - 1`` words choose the same seed in every text.
    """
    n = len(hashes) - width + 1
    if n < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    seeds = window_hash(hashes, width)
    place_bits = np.uint64((1 << max(24, n.bit_length())) - 1)
    least = (seeds & ~place_bits) | np.arange(n, dtype=np.uint64)
    size = 1
    while size < window:  # the least of two overlapping windows is that of a longer one
        step = min(size, window - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    ends = np.repeat(bounds[1:], np.diff(bounds))[: len(least)]
    inside = np.arange(len(least)) + window + width - 1 <= ends
    at = (least[inside] & place_bits).astype(np.int64)  # never falls
    at = at[np.diff(at, prepend=-1) > 0]
    row = np.searchsorted(bounds, at, "right") - 1
    return seeds[at], row, at - bounds[row]


def _match_rows(rows: dict, order, n_buckets: int, of_group, kind: int):
    """(packed rows, what was matched): places matched to the first place of their seed.

    ``order`` sorts by seed, doc_id and place; ``of_group`` marks the rows of the seeds that are
    matched. Places in the first document are only marked as repeated by others.
    """
    seeds, ids = rows["seed"][order], rows["doc_id"][order]
    begin = np.flatnonzero(np.concatenate(([True], seeds[1:] != seeds[:-1])))
    sizes = np.diff(np.append(begin, len(order)))
    first = np.repeat(order[begin], sizes)
    later = of_group & (ids != rows["doc_id"][first])
    shared = np.repeat(np.logical_or.reduceat(later, begin), sizes)
    at, hub = order[later], first[later]
    columns = [rows["doc_id"][at], rows["version"][at], rows["pos"][at]]
    columns += [rows["doc_id"][hub], rows["version"][hub], rows["pos"][hub]]
    packed = by_bucket(bucket_of_ids(columns[0], n_buckets), columns, MATCH_TYPES)
    out = [(kind, b, blob) for b, blob in packed]
    if kind == MATCH:
        own = order[shared & (ids == rows["doc_id"][first])]
        columns = [rows[name][own] for name, _ in MARK_TYPES]
        packed = by_bucket(bucket_of_ids(columns[0], n_buckets), columns, MARK_TYPES)
        out += [(MARK, b, blob) for b, blob in packed]
    return out, later


def _sorted_seeds(rows: dict):
    order = np.lexsort((rows["pos"], rows["version"], rows["doc_id"], rows["seed"]))
    seeds = rows["seed"][order]
    begin = np.flatnonzero(np.concatenate(([True], seeds[1:] != seeds[:-1])))
    return order, np.diff(np.append(begin, len(order)))


def _dealt_seeds(
    held: list, n_seeds: int, n_texts: int, kind: int, unmet: int = SEED
) -> pa.RecordBatch:
    """Seeds dealt to buckets; those that are hot here are matched here to their first place."""
    rows = {name: np.concatenate([h[i] for h in held]) for i, (name, _) in enumerate(SEED_TYPES)}
    if not len(rows["seed"]):
        return rows_batch([])
    order, count = _sorted_seeds(rows)
    hot = np.repeat(count >= HOT_PLACES, count)
    out, matched = _match_rows(rows, order, n_texts, hot, kind)
    sent = np.sort(order[~matched])
    columns = [rows[name][sent] for name, _ in SEED_TYPES]
    packed = by_bucket(bucket_of(columns[0], n_seeds), columns, SEED_TYPES)
    return rows_batch(out + [(unmet, b, blob) for b, blob in packed])


def _seed_function(width: int, window: int, n_seeds: int, n_texts: int):
    """Seeds of all texts; a seed that is hot inside a task is matched there to its first place."""

    def send(batches):
        hasher, held, size = SpanHash(), [], 0
        for batch in pieces(batches, "text"):
            data, offsets = byte_view(batch.column("text"))
            seeds, row, pos = minimizers(*word_hashes(data, offsets, hasher), width, window)
            ids = batch.column("doc_id").to_numpy()
            held.append((seeds, ids[row], batch.column("version").to_numpy()[row], pos))
            size += len(data)
            if size >= FLUSH_BYTES:
                yield _dealt_seeds(held, n_seeds, n_texts, MATCH)
                held, size = [], 0
        if held:
            yield _dealt_seeds(held, n_seeds, n_texts, MATCH)

    return send


def _meet_function(n_texts: int, kind: int):
    """Every place of a seed matched to the seed's first place, in the smallest document."""

    def meet(table: pa.Table) -> pa.Table:
        rows = unpack(table.column("packed").to_pylist(), SEED_TYPES)
        out = []
        if len(rows["seed"]):
            order, _ = _sorted_seeds(rows)
            out, _ = _match_rows(rows, order, n_texts, np.ones(len(order), bool), kind)
        return pa.Table.from_batches([rows_batch(out)])

    return meet


def _of_kind(table: pa.Table, kinds, types) -> dict[str, np.ndarray]:
    packed = zip(table.column("kind").to_pylist(), table.column("packed").to_pylist())
    return unpack([blob for kind, blob in packed if kind in kinds], types)


def _by_text(rows: dict):
    """((doc_id, version), its rows) of rows sorted by these."""
    ids, versions = rows["doc_id"], rows["version"]
    begin = np.flatnonzero((np.diff(ids) != 0) | (np.diff(versions) != 0)) + 1
    begin = np.concatenate(([0], begin)) if len(ids) else begin
    for i, j in zip(begin, [*begin[1:], len(ids)]):
        yield (int(ids[i]), int(versions[i])), {name: of[i:j] for name, of in rows.items()}


def repeated_windows(places: np.ndarray, n_words: int, length: int, width: int, window: int):
    """Where ``length`` words can begin that another document holds as well.

    ``places`` are the sorted seeds of the text that occur in other documents. Equal words have
    equal seeds, so each ``window`` runs inside of such words hold one of the places.
    """
    runs = length - width + 1
    cuts = np.flatnonzero(np.diff(places) > window) + 1
    begin = places[np.concatenate(([0], cuts))] - (window - 1)
    end = places[np.concatenate((cuts, [len(places)])) - 1] + window - runs
    begin, end = np.maximum(begin, 0), np.minimum(end, n_words - length)
    return np.unique(ranges(begin, np.maximum(end - begin + 1, 0)))


def equal_stretches(rows: dict, width: int) -> np.ndarray:
    """Bounds of each row's stretch, whose seeds leave out no word and match one hub in step.

    ``rows`` are the matches of one text by place. A stretch's words are equal in both texts.
    """
    pos = rows["pos"].astype(np.int64)
    new = np.diff(pos) > width
    for key in (rows["hub"], rows["hub_version"], rows["hub_pos"].astype(np.int64) - pos):
        new |= np.diff(key) != 0
    cuts = np.flatnonzero(new)
    begin, last = np.append(0, cuts + 1), np.append(cuts, len(pos) - 1)
    return np.stack([pos[begin], pos[last] + width], axis=1)


def edges(rows: dict):
    """(key, place, origin, next place) where the matches of a text go over to another hub.

    ``rows`` are the matches of one text by place. The key names both hubs, the place is the last
    one with the first hub, and the origin where that hub's beginning would lie in the text. Edges
    over one hub between count too: it may be lost in another text, or hold only words between.
    """
    pos, hub, version = rows["pos"].astype(np.int64), rows["hub"], rows["hub_version"]
    cuts = np.flatnonzero((np.diff(hub) != 0) | (np.diff(version) != 0))
    at, to = np.append(cuts, cuts[:-1]), np.append(cuts, cuts[1:]) + 1
    near = pos[to] - pos[at] <= EDGE_WORDS
    at, to = at[near], to[near]
    key = np.zeros(len(at), np.uint64)
    for part in (hub[at], version[at], hub[to], version[to]):
        key = mixed(key * np.uint64(0xD6E8FEB86659FD93) + part.astype(np.uint64))
    return key, pos[at], pos[at] - rows["hub_pos"][at].astype(np.int64) + ORIGIN, pos[to]


def _window_function(length: int, width: int, window: int, n_seeds: int, n_texts: int):
    """Hashes of the runs of ``length`` words whose seeds all occur in other documents too, and edges.

    A run inside of a stretch that is equal in an earlier document is left out: the passage with
    that document holds it. The first document with the run is in no such stretch and sends it.
    """

    def send(texts: pa.Table, found: pa.Table) -> pa.Table:
        matches, marks = _of_kind(found, [MATCH], MATCH_TYPES), _of_kind(found, [MARK], MARK_TYPES)
        order = np.lexsort((matches["pos"], matches["version"], matches["doc_id"]))
        matches = {name: values[order] for name, values in matches.items()}
        stretches = {name: rows for name, rows in _by_text(matches)}
        rows = {name: np.concatenate((matches[name], marks[name])) for name, _ in MARK_TYPES}
        order = np.lexsort((rows["pos"], rows["version"], rows["doc_id"]))
        rows = {name: values[order] for name, values in rows.items()}
        by_text = {name: np.unique(of["pos"]).astype(np.int64) for name, of in _by_text(rows)}
        out, held, size, hasher = [rows_batch([])], [], 0, SpanHash()
        of_edges = []
        for (doc_id, version), of in stretches.items():
            keys, _, origin, _ = edges(of)
            of_edges.append((keys, np.full(len(keys), doc_id), np.full(len(keys), version), origin))
        if of_edges:
            out.append(_dealt_seeds(of_edges, n_seeds, n_texts, EDGE, EDGE_SEED))
        for ids, versions, data, offsets in text_blocks(texts) if by_text else ():
            names = list(zip(ids.tolist(), versions.tolist()))
            if not any(name in by_text for name in names):
                continue
            hashes, bounds = word_hashes(data, offsets, hasher)
            for row, name in enumerate(names):
                own = by_text.pop(name, None)  # a repeated row finds nothing
                if own is None:
                    continue
                inside = hashes[bounds[row] : bounds[row + 1]]
                at = repeated_windows(own, len(inside), length, width, window)
                if name in stretches:
                    begin, end = equal_stretches(stretches[name], width).T
                    of = np.searchsorted(begin, at, "right") - 1
                    at = at[(of < 0) | (at + length > end[of])]
                if len(at):
                    keys = window_hash(inside, length)[at]
                    held.append((keys, np.full(len(at), name[0]), np.full(len(at), name[1]), at))
                    size += 8 * len(at)
                if size >= FLUSH_BYTES:
                    out.append(_dealt_seeds(held, n_seeds, n_texts, LONG))
                    held, size = [], 0
        if held:
            out.append(_dealt_seeds(held, n_seeds, n_texts, LONG))
        return pa.Table.from_batches(out)

    return send


def exact_runs(rows: dict, length: int, width: int):
    """(text, hub, places, hub's places): the first and last seed of each stretch of equal words.

    ``rows`` are matched windows of ``length`` words; neighbouring ones are one stretch.
    """
    shift = rows["hub_pos"].astype(np.int64) - rows["pos"]
    keys = [rows[n] for n in ("doc_id", "version", "hub", "hub_version")]
    order = np.lexsort((rows["pos"], shift, *keys[::-1]))
    new = np.diff(rows["pos"][order].astype(np.int64)) > length
    for key in (*keys, shift):
        new |= np.diff(key[order]) != 0
    begin = np.concatenate(([0], np.flatnonzero(new) + 1)) if len(order) else np.zeros(0, np.int64)
    last = np.append(begin[1:], len(order)) - 1
    for i, j in zip(order[begin], order[last]):
        doc, version, hub, hub_version = (int(key[i]) for key in keys)
        p = np.array([rows["pos"][i], int(rows["pos"][j]) + length - width], np.int64)
        yield (doc, version), (hub, hub_version), p, p + shift[i]


def sure_passage(p: np.ndarray, h: np.ndarray, width: int, length: int, percent: int):
    """(begin, end) of a chain whose seeds alone make it long and alike enough, or None."""
    span = int(p[-1] - p[0]) + width
    longest = max(span, int(h[-1] - h[0]) + width)
    held = width + int(np.minimum(np.minimum(np.diff(p), np.diff(h)), width).sum())
    sure = min(span, int(h[-1] - h[0]) + width) >= length and 100 * held >= percent * longest
    return (int(p[0]), int(p[0]) + span) if sure else None


def chains_over_edges(matches: dict, met: dict, sure: dict):
    """(text, hub, places, hub's places) of edges that an earlier document has as well.

    The places are the text's last ones before the edges that lie in step with the hub. Edges with
    both sides in passages that are ``sure`` for this text are left out.
    """
    order = np.lexsort((matches["pos"], matches["version"], matches["doc_id"]))
    by_text = dict(_by_text({name: values[order] for name, values in matches.items()}))
    order = np.lexsort((met["version"], met["doc_id"]))
    for name, rows in _by_text({name: values[order] for name, values in met.items()}):
        _, places, origins, after = edges(by_text[name])
        inside = np.zeros((2, len(places)), bool)
        for begin, end in sure.get(name, ()):
            inside |= (np.stack([places, after]) >= begin) & (np.stack([places, after]) < end)
        needed = ~inside.all(axis=0)
        columns = [rows[n].tolist() for n in ("hub", "hub_version", "pos", "hub_pos")]
        in_step: dict[tuple, list] = {}
        for hub, version, origin, hub_origin in sorted(set(zip(*columns))):
            p = places[needed & (origins == origin)]
            in_step.setdefault((hub, version, origin - hub_origin), []).append(p)
        for (hub, version, shift), held in sorted(in_step.items(), key=lambda item: item[0]):
            p = np.unique(np.concatenate(held))
            p = p[p >= shift]
            if len(p):
                yield name, (hub, version), p, p - shift


class PrefixMax:
    """A Fenwick tree: the largest value among the first places, and who holds it."""

    def __init__(self, n: int):
        self.values, self.owners = [float("-inf")] * (n + 1), [-1] * (n + 1)

    def put(self, place: int, value: float, owner: int) -> None:
        place += 1
        while place < len(self.values):
            if value > self.values[place]:
                self.values[place], self.owners[place] = value, owner
            place += place & -place

    def before(self, place: int) -> tuple[float, int]:
        """The best of the places below ``place``."""
        best, owner = float("-inf"), -1
        while place > 0:
            if self.values[place] > best:
                best, owner = self.values[place], self.owners[place]
            place -= place & -place
        return best, owner


def chains(p: np.ndarray, h: np.ndarray, gap_cost: float = GAP_COST) -> list[np.ndarray]:
    """Chains of matches (p, h) that rise in both texts, the best first; each match in one.

    A match scores 1, a step costs ``gap_cost`` per word it moves on in either text. The best
    predecessor is the largest score + cost * (p + h) among matches earlier in both, which a
    Fenwick tree over ``h`` gives while ``p`` rises.
    """
    order = np.lexsort((-h, p))
    p, h = p[order], h[order]
    steps = np.diff(p) + np.diff(h)
    if (np.diff(p) > 0).all() and (np.diff(h) > 0).all() and (steps * gap_cost < 1).all():
        return [order]  # all rise and every step gains: no choice is better
    rank = np.unique(h, return_inverse=True)[1].tolist()
    sums = (gap_cost * (p + h)).tolist()
    tree = PrefixMax(max(rank) + 1)
    score, previous = [], []
    for j in range(len(p)):
        best, i = tree.before(rank[j])
        gain = best - sums[j]
        score.append(1 + max(0.0, gain))
        previous.append(i if gain > 0 else -1)
        tree.put(rank[j], score[j] + sums[j], j)
    used, found = [False] * len(p), []
    for j in sorted(range(len(p)), key=lambda j: (-score[j], j)):
        chain = []
        while j >= 0 and not used[j]:
            used[j] = True
            chain.append(j)
            j = previous[j]
        if chain:
            found.append(order[np.array(chain[::-1])])
    return found


CHAINS = (
    "doc_id bigint, hub bigint, hub_version bigint, hub_first bigint, hub_after bigint, "
    "seeds binary, first bigint, words binary, exact boolean"
)


def _chain_function(width: int, gap_cost: float, least_seeds: int, length: int, percent: int):
    """The chains of each document with each hub, and the document's words around them."""

    def chain(texts: pa.Table, found: pa.Table) -> pa.Table:
        rows = _of_kind(found, [MATCH], MATCH_TYPES)
        order = np.lexsort(
            (rows["pos"], rows["hub_version"], rows["hub"], rows["version"], rows["doc_id"])
        )
        rows = {name: values[order] for name, values in rows.items()}
        new = np.zeros(len(order), bool)
        for name in ("doc_id", "version", "hub", "hub_version"):
            new[1:] |= rows[name][1:] != rows[name][:-1]
        begin = np.flatnonzero(np.concatenate((new[:1] | True, new[1:]))) if len(order) else []
        by_text: dict[tuple, list] = {}
        for start, end in zip(begin, [*begin[1:], len(order)]):
            if end - start < least_seeds:
                continue
            p = rows["pos"][start:end].astype(np.int64)
            h = rows["hub_pos"][start:end].astype(np.int64)
            for one in chains(p, h, gap_cost):
                if len(one) >= least_seeds:
                    name = (int(rows["doc_id"][start]), int(rows["version"][start]))
                    hub = (int(rows["hub"][start]), int(rows["hub_version"][start]))
                    by_text.setdefault(name, []).append((hub, p[one], h[one], False))
        runs: dict[tuple, list] = {}
        for name, hub, p, h in exact_runs(_of_kind(found, [LONG], MATCH_TYPES), length, width):
            by_text.setdefault(name, []).append((hub, p, h, True))
            runs.setdefault((name, hub, int(h[0] - p[0])), []).append((p[0], p[1] + width))
        met = _of_kind(found, [EDGE], MATCH_TYPES)
        sure = {
            name: [
                span
                for _, p, h, exact in held
                if (span := (p[0], p[-1] + width) if exact else sure_passage(p, h, width, length, percent))
            ]
            for name, held in by_text.items()
        }
        for name, hub, p, h in chains_over_edges(rows, met, sure):
            far = np.ones(len(p), bool)  # what an equal run in step is not extended to
            for begin, end in runs.get((name, hub, int(h[0] - p[0])), ()):
                far &= (p < begin - MARGIN) | (p > end + MARGIN)
            if far.any():
                by_text.setdefault(name, []).append((hub, p[far], h[far], True))
        out, hasher, done = [], SpanHash(), set()
        for ids, versions, data, offsets in text_blocks(texts) if by_text else ():
            names = list(zip(ids.tolist(), versions.tolist()))
            if not any(name in by_text for name in names):
                continue
            hashes, bounds = word_hashes(data, offsets, hasher)
            short = hashes.astype(np.uint32)
            for row, name in enumerate(names):
                if name in done:  # a repeated row
                    continue
                done.add(name)
                for hub, p, h, exact in by_text.get(name, ()):
                    n = int(bounds[row + 1] - bounds[row])
                    first = max(0, int(p[0]) - MARGIN)
                    after = min(n, int(p[-1]) + width + MARGIN)
                    own = short[bounds[row] + first : bounds[row] + after]
                    seeds = np.stack([p, h], axis=1).astype(np.uint32)
                    ends = max(0, int(h[0]) - MARGIN), int(h[-1]) + width + MARGIN
                    out.append((name[0], *hub, *ends, seeds.tobytes(), first, own.tobytes(), exact))
        columns = list(zip(*out)) if out else [()] * 9
        kinds = [pa.int64()] * 5 + [pa.binary(), pa.int64(), pa.binary(), pa.bool_()]
        names = ["doc_id", "hub", "hub_version", "hub_first", "hub_after"]
        names += ["seeds", "first", "words", "exact"]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return chain


def _hub_buckets(n_texts: int):
    def deal(batches):
        for batch in batches:
            buckets = bucket_of_ids(batch.column("hub").to_numpy(), n_texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets, pa.int32()), batch.column("hub"), batch.column("hub_version")],
                names=["bucket", "hub", "hub_version"],
            )

    return deal


def _words_function():
    """The word hashes of the documents that are hubs."""

    def take(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        wanted = set(zip(wanted.column("hub").to_pylist(), wanted.column("hub_version").to_pylist()))
        out, hasher = {}, SpanHash()
        for ids, versions, data, offsets in text_blocks(texts) if wanted else ():
            names = list(zip(ids.tolist(), versions.tolist()))
            if not any(name in wanted for name in names):
                continue
            hashes, bounds = word_hashes(data, offsets, hasher)
            short = hashes.astype(np.uint32)
            for row, name in enumerate(names):
                if name in wanted:
                    out[name] = short[bounds[row] : bounds[row + 1]].tobytes()
        return pa.table(
            {
                "hub": pa.array([n[0] for n in out], pa.int64()),
                "hub_version": pa.array([n[1] for n in out], pa.int64()),
                "hub_words": pa.array(list(out.values()), pa.binary()),
            }
        )

    return take


def common_words(a: np.ndarray, b: np.ndarray) -> int:
    """The most words that an alignment of two short texts can match, in order."""
    best = np.zeros(len(b) + 1, np.int64)
    for word in a:
        take = best[:-1] + (b == word)
        best[1:] = np.maximum.accumulate(np.maximum(best[1:], take))
    return int(best[-1])


def extended(same: np.ndarray, gain: int = 1, drop: int = DROP) -> int:
    """How far to go on while matches, ``gain`` each, outweigh mismatches, one each.

    It gives up ``drop`` below the best.
    """
    if not same[:drop].any():
        return 0
    score = np.cumsum(np.where(same, gain, -1))
    best = np.maximum.accumulate(np.maximum(score, 0))
    fallen = np.flatnonzero(best - score >= drop)
    score = score[: fallen[0]] if len(fallen) else score
    if not len(score) or score.max() <= 0:
        return 0
    return int(np.argmax(score)) + 1


def aligned(a: np.ndarray, b: np.ndarray, seeds: np.ndarray, width: int, gain: int = 1):
    """(start and end in a, start and end in b, matched words) of a chain, with its ends extended.

    ``seeds`` are places in ``a`` and ``b``. Between seeds equally long gaps are compared word by
    word, others by their best alignment.
    """
    p, h = seeds[:, 0], seeds[:, 1]
    left = int(min(p[0], h[0]))
    end_a, end_b = int(p[-1]) + width, int(h[-1]) + width
    right = min(len(a) - end_a, len(b) - end_b)
    in_step = bool((p - h == p[0] - h[0]).all())
    if in_step:
        low = int(p[0]) - left
        same = a[low : end_a + right] == b[int(h[0]) - left : end_b + right]
        before = extended(same[:left][::-1], gain)
        after = extended(same[end_a - low :], gain)
        matches = int(np.count_nonzero(same[left - before : end_a - low + after]))
    else:
        before = extended((a[p[0] - left : p[0]] == b[h[0] - left : h[0]])[::-1], gain)
        after = extended(a[end_a : end_a + right] == b[end_b : end_b + right], gain)
    start_a, start_b = int(p[0]) - before, int(h[0]) - before
    end_a, end_b = end_a + after, end_b + after
    if not in_step:
        matches = int((a[start_a : p[0]] == b[start_b : h[0]]).sum())
        matches += int((a[p[-1] : end_a] == b[h[-1] : end_b]).sum())
        for i in range(len(p) - 1):
            x, y = a[p[i] : p[i + 1]], b[h[i] : h[i + 1]]
            same = len(x) == len(y)
            matches += int((x == y).sum()) if same else common_words(x, y)
    return start_a, end_a, start_b, end_b, matches


PASSAGES = (
    "doc_id bigint, other_id bigint, start_word bigint, end_word bigint, "
    "other_start bigint, other_end bigint, n_matched bigint, exact boolean"
)


def passages_of(
    a: np.ndarray, b: np.ndarray, seeds: np.ndarray, width: int, least_words: int, percent: int
) -> list[tuple]:
    """What ``aligned`` gives for a chain where it is long and alike enough.

    A chain that is too short is extended over ends with fewer matches. One that is not alike
    enough is cut where its seeds leave out words or get out of step, and each part is tried.
    """

    def passes(found):
        ends = found[1] - found[0], found[3] - found[2]
        return min(ends) >= least_words and 100 * found[4] >= percent * max(ends)

    for gain in (1, END_GAIN):
        found = aligned(a, b, seeds, width, gain)
        if passes(found):
            return [found]
    p, h = seeds[:, 0], seeds[:, 1]
    cuts = np.flatnonzero((np.diff(p) > width) | (np.diff(p) != np.diff(h))) + 1
    if not len(cuts):
        return []
    parts, seen = [], -1
    for part in np.split(seeds, cuts):
        if part[0, 0] >= seen:  # not inside of what an earlier part was extended to
            found = aligned(a, b, part, width)
            if passes(found):
                parts.append(found)
                seen = found[1]
    return parts


def _align_function(width: int, least_words: int, percent: int):
    def align(batches):
        names = ["doc_id", "other_id", "start_word", "end_word", "other_start", "other_end", "n_matched"]
        kinds = [pa.int64()] * 7 + [pa.bool_()]
        for batch in batches:
            out = []
            columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            for row in range(batch.num_rows):
                seeds = np.frombuffer(columns["seeds"][row], np.uint32).astype(np.int64).reshape(-1, 2)
                first, hub_first = columns["first"][row], columns["hub_first"][row]
                a = np.frombuffer(columns["words"][row], np.uint32)
                b = np.frombuffer(columns["hub_words"][row], np.uint32)
                seeds = seeds - [first, hub_first]
                if seeds[-1, 1] + width > len(b):  # an edge of a hub that ends before
                    continue
                for found in passages_of(a, b, seeds, width, least_words, percent):
                    out.append(
                        (columns["doc_id"][row], columns["hub"][row], found[0] + first,
                         found[1] + first, found[2] + hub_first, found[3] + hub_first, found[4],
                         columns["exact"][row])
                    )
            fields = list(zip(*out)) if out else [()] * 8
            arrays = [pa.array(f, kind) for f, kind in zip(fields, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "exact"])

    return align


def repeated_passages(
    docs: DataFrame,
    width: int = SEED_WORDS,
    window: int = WINDOW,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """(doc_id, other_id, start_word, end_word, other_start, other_end, n_matched).

    A row is a passage of at least ``least_words`` words of a document, of which at least
    ``percent`` in a hundred align with a passage of an earlier document. Places count words, the
    end exclusive. A text's first holder has no row of its own as ``doc_id``.

    1. Seeds, the least of each ``window`` runs of ``width`` words, are matched to their first
       place in the corpus, the smallest doc_id; so copies cost matches, not pairs.
    2. Runs of ``least_words`` words whose seeds all occur in other documents, but not all in step
       in one, are matched to the first place of the whole run. So no equal words of that length
       are lost where their parts are first held by different documents.
       Where a document's matches go over from one earlier document to another, the two name an
       edge, which is matched to the first document that has the same edge; so reworded passages
       whose parts were first held by several documents meet one that holds them together.
    3. A document's matches with one earlier document are chained.
    4. Chains are aligned on the words of both documents and extended at their ends, see
       ``passages_of``.

    Null and empty texts have no words. Rows without doc_id take no part; rows that share one are
    one document and do not repeat each other. Repeated rows count once. A passage that is only
    repeated inside its own document is not listed. No rows give no rows.
    """
    if least_words < width + window - 1:
        raise ValueError("least_words must hold a window of seeds")
    rows = keyed(docs).where(F.col("doc_id") != NO_ID)
    n_texts = bucket_count(docs)
    n_seeds = bucket_count(docs, SEED_BUCKET_BYTES)
    sent = cut(rows.mapInArrow(_seed_function(width, window, n_seeds, n_texts), ROWS))
    met = cut(
        sent.where(F.col("kind") == SEED)
        .groupBy("bucket")
        .applyInArrow(_meet_function(n_texts, MATCH), ROWS)
    )
    matches = sent.where(F.col("kind") != SEED).unionByName(met)
    long = cut(
        texts_by_bucket(rows, n_texts).groupBy("bucket")
        .cogroup(matches.groupBy("bucket"))
        .applyInArrow(_window_function(least_words, width, window, n_seeds, n_texts), ROWS)
    )
    matches = matches.where(F.col("kind") == MATCH)
    matches = matches.unionByName(long.where(F.col("kind").isin(LONG, EDGE)))
    for unmet, kind in ((SEED, LONG), (EDGE_SEED, EDGE)):
        long_met = (
            long.where(F.col("kind") == unmet)
            .groupBy("bucket")
            .applyInArrow(_meet_function(n_texts, kind), ROWS)
        )
        matches = matches.unionByName(long_met)
    chained = cut(
        texts_by_bucket(rows, n_texts).groupBy("bucket")
        .cogroup(matches.groupBy("bucket"))
        .applyInArrow(_chain_function(width, GAP_COST, LEAST_SEEDS, least_words, percent), CHAINS)
    )
    hubs = chained.select("hub", "hub_version").distinct()
    hubs = hubs.mapInArrow(_hub_buckets(n_texts), "bucket int, hub bigint, hub_version bigint")
    # few other texts than hubs need to move: at most HUB_CELLS hashes of hubs go to all tasks
    cells = hubs.select(F.pmod(F.xxhash64("hub"), F.lit(HUB_CELLS)).alias("cell")).distinct()
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(HUB_CELLS))
    hub_rows = rows.join(F.broadcast(cells), cell == F.col("cell"), "left_semi")
    hub_words = (
        texts_by_bucket(hub_rows, n_texts).groupBy("bucket")
        .cogroup(hubs.groupBy("bucket"))
        .applyInArrow(_words_function(), "hub bigint, hub_version bigint, hub_words binary")
    )
    # only the hub's words around the chain go on, at four bytes each
    around = F.expr("substring(hub_words, cast(4 * hub_first + 1 as int), 4 * cast(hub_after - hub_first as int))")
    passages = (
        chained.join(hub_words, ["hub", "hub_version"])
        .withColumn("hub_words", around)
        .drop("hub_after", "hub_version")
        .mapInArrow(_align_function(width, least_words, percent), PASSAGES)
    )
    # equal words inside a longer passage of the same two documents are no passage of their own
    before = Window.partitionBy("doc_id", "other_id").orderBy("start_word").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    reach = F.max(F.when(~F.col("exact"), F.col("end_word"))).over(before)
    inside = F.col("exact") & (F.coalesce(reach, F.lit(-1)) >= F.col("end_word"))
    return passages.withColumn("_inside", inside).where(~F.col("_inside")).drop("_inside", "exact")

"""Finding secrets: patterns, and a small character convolution over every other candidate."""

import hashlib
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coterie.llm.buffers import pieces
from coterie.operators.lineage import cut

# The kinds of findings and their patterns, in the order of listing.
ASSIGN = re.compile(
    r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
    r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LONG_HEX = re.compile(r"[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]{8,}")
SHORT_DIGIT, SHORT_LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")
KINDS = ("assign", "access", "hex", "learned")

PART_WINDOWS = 8192
ROUNDS, PARTS_SUMMED = 6, 256
FLUSH_BYTES = 4 << 20
TOKEN, BEFORE, AFTER = 40, 16, 8
TOKEN_STEP = TOKEN // 2
JUDGED = 4096
LEAST_TOKEN, LONG_TOKEN = 8, 16
PART = re.compile(r"[+/_=.-][A-Za-z0-9]")
WIDTH = BEFORE + TOKEN + AFTER
CHANNELS, FILTERS, SPAN = 12, 24, 5
EPOCHS, LEAST_STEPS, STEP, BATCH = 12, 500, 0.01, 64
LEAST_PLANTED = 50
LEAST_RECALL = 0.95
TESTED = 0.2
OUTPUT_CELLS, OUTPUT_MOST = 256, 16
SEED = 11

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# What secrets of other kinds look like, as (name, prefix, alphabet, least, most).
SHAPES = (
    ("hex", "", DIGITS + "abcdef", 16, 40),
    ("upper hex", "", DIGITS + "ABCDEF", 16, 40),
    ("base64", "", UPPER + LOWER + DIGITS + "+/", 20, 44),
    ("letters and digits", "", UPPER + LOWER + DIGITS, 12, 40),
    ("upper letters and digits", "", UPPER + DIGITS, 16, 32),
    ("lower letters and digits", "", LOWER + DIGITS, 12, 36),
    ("ghp_", "ghp_", UPPER + LOWER + DIGITS, 36, 36),
    ("sk-", "sk-", UPPER + LOWER + DIGITS, 32, 48),
)


def base_findings(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' findings, leftmost and without overlap in each kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(found)


def is_candidate(text: str, start: int, end: int) -> bool:
    """Whether a run can be a secret: it is long, or not short and holds a digit and a letter."""
    if end - start >= LONG_TOKEN:
        return True
    return (
        end - start >= LEAST_TOKEN
        and SHORT_DIGIT.search(text, start, end) is not None
        and SHORT_LETTER.search(text, start, end) is not None
    )


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of runs of token characters, without what the patterns found of them."""
    found, taken = [], sorted((start, end) for start, _, end in base)
    following = 0
    for m in CANDIDATE.finditer(text):
        at = m.start()
        while following < len(taken) and taken[following][0] < m.end():
            start, end = taken[following]
            if is_candidate(text, at, start):
                found.append((at, start))
            at = max(at, end)
            if end > m.end():  # it may reach into the next run as well
                break
            following += 1
        if is_candidate(text, at, m.end()):
            found.append((at, m.end()))
    return found


def windows(text: str, start: int, end: int) -> list[int]:
    """Where to look at a token: its start, its parts, and steps that overlap, up to its end."""
    if end - start <= TOKEN:
        return [start]
    places = {start, end - TOKEN, *range(start, end - TOKEN, TOKEN_STEP)}
    # a part near the end is looked at on its own as well
    places |= {m.start() + 1 for m in PART.finditer(text, start, end)}
    return sorted(places)


def _classes() -> np.ndarray:
    """Code points to the network's alphabet: ASCII as it is, space, and one for all others."""
    table = np.full(129, 127, np.uint8)
    table[:127] = np.arange(127)
    return table


CLASSES = _classes()


def encoded_windows(text: str, places: list[tuple[int, int]]) -> np.ndarray:
    """For each (start, end) the first ``TOKEN`` characters and what surrounds them, as symbols.

    0 fills what is missing; the token's own characters are marked by a second half of symbols.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    padded = np.zeros(BEFORE + len(codes) + TOKEN + AFTER, np.uint8)
    padded[BEFORE : BEFORE + len(codes)] = CLASSES[np.minimum(codes, 128)]
    start, end = np.array(places, np.int64).reshape(-1, 2).T
    rows = np.zeros((len(start), WIDTH), np.uint8)
    rows[:, :BEFORE] = padded[start[:, None] + np.arange(BEFORE)]
    token = start[:, None] + np.arange(TOKEN)
    rows[:, BEFORE : BEFORE + TOKEN] = np.where(token < end[:, None], padded[token + BEFORE] + 128, 0)
    rows[:, BEFORE + TOKEN :] = padded[end[:, None] + np.arange(AFTER) + BEFORE]
    return rows


def encoded(text: str, start: int, end: int) -> np.ndarray:
    """One window of a text."""
    return encoded_windows(text, [(start, end)])[0]


def planted(rows: np.ndarray, shape: tuple, random: np.random.Generator) -> np.ndarray:
    """The windows with generated secrets of a shape in place of their tokens."""
    _, prefix, alphabet, least, most = shape
    out = rows.copy()
    out[:, BEFORE : BEFORE + TOKEN] = 0
    letters = np.frombuffer(alphabet.encode(), np.uint8)
    head = np.frombuffer(prefix.encode(), np.uint8)
    for row in out:
        value = np.concatenate((head, random.choice(letters, random.integers(least, most + 1))))[:TOKEN]
        row[BEFORE : BEFORE + len(value)] = value + 128
    return out


class Network(NamedTuple):
    """A character convolution: embedding, filters, the most active place, a logistic output."""

    embedding: np.ndarray
    filters: np.ndarray
    filter_bias: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    scale: float
    shift: float
    threshold: float


def _forward(rows: np.ndarray, net: Network):
    embedded = net.embedding[rows]
    n = len(rows)
    windows = np.lib.stride_tricks.sliding_window_view(embedded, SPAN, axis=1)
    windows = windows.transpose(0, 1, 3, 2).reshape(n, WIDTH - SPAN + 1, SPAN * CHANNELS)
    active = np.maximum(windows @ net.filters + net.filter_bias, 0)
    place = active.argmax(axis=1)
    peak = np.take_along_axis(active, place[:, None], axis=1)[:, 0]
    mean = active.mean(axis=1)
    both = np.concatenate((peak, mean), axis=1)
    return windows, active, place, both, both @ net.weights + net.bias


def logits(rows: np.ndarray, net: Network) -> np.ndarray:
    """The network's output for each window, from what each symbol adds at each place of a filter.

    It is rounded down to a fixed number of values, so that those of any number of windows can be
    counted: calibration and threshold come from the counts of all of them.
    """
    filters = net.filters.reshape(SPAN, CHANNELS, FILTERS)
    adds = [(net.embedding @ filters[k]).astype(np.float32) for k in range(SPAN)]
    out, width = [np.zeros(0)], WIDTH - SPAN + 1
    for at in range(0, len(rows), 512):
        part = rows[at : at + 512]
        active = adds[0][part[:, :width]]
        for k in range(1, SPAN):
            active += adds[k][part[:, k : k + width]]
        active = np.maximum(active + net.filter_bias.astype(np.float32), 0)
        both = np.concatenate((active.max(axis=1), active.mean(axis=1)), axis=1)
        out.append(both @ net.weights + net.bias)
    out = np.clip(np.concatenate(out), -OUTPUT_MOST, OUTPUT_MOST)
    return np.floor(out * OUTPUT_CELLS) / OUTPUT_CELLS


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def initial(random: np.random.Generator) -> list[np.ndarray]:
    """The network's values before training."""
    return [
        random.normal(0, 0.3, (256, CHANNELS)),
        random.normal(0, 0.2, (SPAN * CHANNELS, FILTERS)),
        np.zeros(FILTERS),
        random.normal(0, 0.2, 2 * FILTERS),
        np.zeros(1),
    ]


def epochs_of(n: int) -> int:
    """How often ``n`` examples are gone through."""
    return max(EPOCHS, LEAST_STEPS * BATCH // max(n, 1))


def descend(
    values: list[np.ndarray], rows: np.ndarray, labels: np.ndarray, epochs: int, random: np.random.Generator
) -> list[np.ndarray]:
    """The values after going through the examples: Adam on the logistic loss."""
    first, second, step = [0 * v for v in values], [0 * v for v in values], 0
    used, values = np.arange(len(rows)), list(values)
    for _ in range(epochs):
        random.shuffle(used)
        for at in range(0, len(used), BATCH):
            chosen = used[at : at + BATCH]
            net = Network(*values, 1.0, 0.0, 0.5)
            windows, active, place, both, out = _forward(rows[chosen], net)
            error = (_sigmoid(out) - labels[chosen]) / len(chosen)
            of_both = error[:, None] * values[3]
            of_active = np.repeat(of_both[:, None, FILTERS:] / active.shape[1], active.shape[1], axis=1)
            peak = np.take_along_axis(of_active, place[:, None], axis=1)
            np.put_along_axis(of_active, place[:, None], peak + of_both[:, None, :FILTERS], axis=1)
            of_active = of_active * (active > 0)
            flat = of_active.reshape(-1, FILTERS)
            of_windows = (of_active @ values[1].T).reshape(len(chosen), -1, SPAN, CHANNELS)
            of_symbols = np.zeros((len(chosen), WIDTH, CHANNELS))
            for k in range(SPAN):
                of_symbols[:, k : k + of_windows.shape[1]] += of_windows[:, :, k]
            symbols, of_symbols = rows[chosen].ravel(), of_symbols.reshape(-1, CHANNELS)
            sums = [np.bincount(symbols, of_symbols[:, c], len(values[0])) for c in range(CHANNELS)]
            of_embedding = np.stack(sums, axis=1)
            slopes = [
                of_embedding,
                windows.reshape(-1, SPAN * CHANNELS).T @ flat,
                flat.sum(axis=0),
                both.T @ error,
                np.array([error.sum()]),
            ]
            step += 1
            for i, slope in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                change = first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
                values[i] = values[i] - STEP * change
    return values


def calibrated(
    values: list[np.ndarray], out: np.ndarray, truth: np.ndarray, n: np.ndarray, least_recall: float
) -> Network:
    """The network, calibrated on outputs that examples kept aside have ``n`` times each.

    The calibration is a scale and a shift of the output. The threshold is the highest at which
    the kept-aside findings are recalled to ``least_recall``.
    """
    net = Network(*values, 1.0, 0.0, 0.5)
    if not len(out):
        return net
    scale, shift, share = 1.0, 0.0, n / n.sum()
    for _ in range(200):
        error = (_sigmoid(scale * out + shift) - truth) * share
        scale -= 0.5 * (error * out).sum() / max(1.0, (out**2 * share).sum())
        shift -= 0.5 * error.sum()
    scores, times = _sigmoid(scale * out + shift)[truth == 1], n[truth == 1]
    order = np.argsort(scores)
    up_to = np.cumsum(times[order])
    threshold = 1.0
    if len(up_to):
        threshold = scores[order][np.searchsorted(up_to, int((1 - least_recall) * up_to[-1]), "right")]
    return net._replace(scale=scale, shift=shift, threshold=float(threshold))


def train_network(rows: np.ndarray, labels: np.ndarray, least_recall: float = LEAST_RECALL) -> Network:
    """Fit the network on labelled windows of one task, then calibrate it on a quarter kept aside."""
    random = np.random.default_rng(SEED)
    order = random.permutation(len(rows))
    kept, used = order[: len(order) // 4], order[len(order) // 4 :]
    values = descend(initial(random), rows[used], labels[used], epochs_of(len(used)), random)
    out = logits(rows[kept], Network(*values, 1.0, 0.0, 0.5))
    return calibrated(values, out, labels[kept], np.ones(len(kept)), least_recall)


def _cut_windows(batches):
    """The labelled windows of all texts, once in a piece of a batch, with a hash of their symbols."""
    for batch in pieces(batches, "text", FLUSH_BYTES):
        seen: dict[int, set] = {0: set(), 1: set()}
        for text in batch.column("text").to_pylist():
            base = base_findings(text)
            found = []
            for start, kind, end in base:
                if kind == 0:  # the value, as it would stand without the name before it
                    start = ASSIGN.match(text, start).start(2)
                found += [(at, end) for at in windows(text, start, end)]
            others = [
                (at, end) for start, end in candidates(text, base) for at in windows(text, start, end)
            ]
            for label, places in ((1, found), (0, others)):
                for first in range(0, len(places), JUDGED):
                    for row in encoded_windows(text, places[first : first + JUDGED]):
                        seen[label].add(row.tobytes())
        raws = [raw for rows in seen.values() for raw in rows]
        ranks = [int.from_bytes(hashlib.blake2b(raw, digest_size=7).digest(), "big") for raw in raws]
        labels = np.repeat([0, 1], [len(seen[0]), len(seen[1])])
        yield pa.RecordBatch.from_arrays(
            [pa.array(labels, pa.int32()), pa.array(ranks, pa.int64()), pa.array(raws, pa.binary())],
            names=["label", "rank", "row"],
        )


PARTS = "part bigint, findings binary, others binary"


def _pack_part(table: pa.Table) -> pa.Table:
    """The windows of a part as one row, each class in the order of its hashes."""
    table = table.sort_by([("rank", "ascending"), ("row", "ascending")])
    labels = table.column("label").to_numpy()
    rows = table.column("row").to_pylist()
    blobs = [b"".join(raw for raw, is_of in zip(rows, labels == label, strict=True) if is_of) for label in (1, 0)]
    return pa.table(
        [table.column("part")[:1], *[pa.array([blob], pa.binary()) for blob in blobs]],
        ["part", "findings", "others"],
    )


def window_parts(docs: DataFrame, most: int = PART_WINDOWS) -> DataFrame | None:
    """All different windows of the corpus in parts of about ``most``, one row (part, findings, others)
    each, or None where the corpus has no candidates but the patterns' findings.

    Parts are dealt by the windows' hashes, so a part is a fair share of both classes.
    """
    if most < 1:
        raise ValueError("most must be positive")
    found = cut(docs.mapInArrow(_cut_windows, "label int, rank bigint, row binary").distinct())
    count = {r["label"]: r["count"] for r in found.groupBy("label").count().collect()}
    if not count.get(0):
        return None
    n_parts = -(-sum(count.values()) // most)
    dealt = found.withColumn("part", F.pmod("rank", F.lit(n_parts))).repartition(n_parts, "part")
    return cut(dealt.groupBy("part").applyInArrow(_pack_part, PARTS))


class Examples(NamedTuple):
    """Windows, whether they are secrets, and their kinds: findings, shapes or other candidates."""

    rows: np.ndarray
    labels: np.ndarray
    kinds: np.ndarray


def part_examples(findings: np.ndarray, others: np.ndarray, random: np.random.Generator) -> Examples:
    """The examples of a part.

    Findings count as they are, and again with the surroundings of other candidates, since a name
    before a value is what the patterns find already. As many secrets of other shapes are planted
    among the same surroundings. Without other candidates there are only the findings.
    """
    parts = [(others, 0.0, "other"), (findings, 1.0, "finding")]
    if len(others):

        def surroundings(n: int) -> np.ndarray:
            return others[random.integers(0, len(others), n)]

        neutral = surroundings(len(findings)).copy()
        neutral[:, BEFORE : BEFORE + TOKEN] = findings[:, BEFORE : BEFORE + TOKEN]
        parts.append((neutral, 1.0, "finding, no name"))
        each = max(LEAST_PLANTED, -(-len(others) // len(SHAPES)))
        parts += [(planted(surroundings(each), shape, random), 1.0, shape[0]) for shape in SHAPES]
    return Examples(
        np.concatenate([rows for rows, _, _ in parts]),
        np.concatenate([np.full(len(rows), label) for rows, label, _ in parts]),
        np.concatenate([np.full(len(rows), kind, object) for rows, _, kind in parts]),
    )


def _unpacked(row: dict, random: np.random.Generator) -> Examples:
    return part_examples(
        *(np.frombuffer(row[name], np.uint8).reshape(-1, WIDTH) for name in ("findings", "others")), random
    )


def _dealt_examples(row: dict) -> tuple[Examples, np.ndarray, np.ndarray, np.ndarray]:
    """A part's examples, the same in every pass, and which are for testing, calibration, training."""
    random = np.random.default_rng([SEED, row["part"]])
    held = _unpacked(row, random)
    order = random.permutation(len(held.rows))
    n_tested = int(TESTED * len(order))
    n_kept = (len(order) - n_tested) // 4
    return held, *np.split(order, [n_tested, n_tested + n_kept])


MODELS = "part bigint, n bigint, model binary"


def _model_batch(part: int, n: int, flat: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([n], pa.int64()), pa.array([flat.tobytes()], pa.binary())],
        names=["part", "n", "model"],
    )


def _shaped(flat: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    ends = np.cumsum([v.size for v in like])[:-1]
    return [part.reshape(v.shape) for part, v in zip(np.split(flat, ends), like, strict=True)]


def _train_function(values: list[np.ndarray], turn: int, turns: int):
    """Each part's values after its share of the epochs, starting from the common ones."""

    def train(batches):
        for batch in batches:
            for row in batch.to_pylist():
                held, _, _, used = _dealt_examples(row)
                if not len(used):
                    continue
                epochs = -(-epochs_of(len(used)) // turns)
                random = np.random.default_rng([SEED, row["part"], turn])
                after = descend(values, held.rows[used], held.labels[used], epochs, random)
                flat = np.concatenate([v.ravel() for v in after])
                yield _model_batch(row["part"], len(used), flat)

    return train


def _average(models: list[tuple[int, int, bytes]]) -> tuple[int, np.ndarray]:
    """(n, mean) of models, weighed by their examples, summed in the order of their parts."""
    total, mean = sum(n for _, n, _ in models), 0.0
    for _, n, model in sorted(models, key=lambda m: m[0]):
        mean = mean + np.frombuffer(model, np.float64) * (n / total)
    return total, mean


def _average_parts(table: pa.Table) -> pa.Table:
    models = list(zip(*(table.column(c).to_pylist() for c in ("part", "n", "model")), strict=True))
    return pa.Table.from_batches([_model_batch(min(m[0] for m in models), *_average(models))])


def _judge_function(values: list[np.ndarray]):
    """How many examples of a kind have each output, of those for testing and for calibration."""

    def judge(batches):
        net = Network(*values, 1.0, 0.0, 0.5)
        for batch in batches:
            for row in batch.to_pylist():
                held, tested, kept, _ = _dealt_examples(row)
                for name, chosen in (("tested", tested), ("kept", kept)):
                    out, kinds = logits(held.rows[chosen], net), held.kinds[chosen]
                    for kind in sorted(set(kinds)):
                        values_, n = np.unique(out[kinds == kind], return_counts=True)
                        label = held.labels[chosen][kinds == kind][0]
                        yield pa.RecordBatch.from_pydict(
                            {
                                "use": pa.array([name] * len(n)),
                                "kind": pa.array([kind] * len(n)),
                                "label": pa.array([label] * len(n), pa.float64()),
                                "out": pa.array(values_),
                                "n": pa.array(n, pa.int64()),
                            }
                        )

    return judge


def learn(docs: DataFrame, most: int = PART_WINDOWS) -> tuple[Network | None, dict[str, tuple[int, float]]]:
    """The network learned from all windows of a corpus, and its report.

    Every part is gone through in every round, by the task that reads it; after a round the parts'
    networks are averaged, in two steps, and the next round starts from the mean. A corpus of one
    part takes all its epochs in one round. Calibration and threshold come from the outputs of all
    examples kept aside, counted over the whole corpus. The report has for each kind of a fifth
    of the examples, used for nothing else, how many there are and the share that the network
    takes for secrets: recall, or for others false alarms.
    """
    parts = window_parts(docs, most)
    if parts is None:
        return None, {}
    values = initial(np.random.default_rng(SEED))
    turns = min(ROUNDS, parts.count())
    for turn in range(turns):
        models = parts.mapInArrow(_train_function(values, turn, turns), MODELS)
        group = F.expr(f"part div {PARTS_SUMMED}").alias("group")
        means = models.groupBy(group).applyInArrow(_average_parts, MODELS).collect()
        if means:
            _, flat = _average([(r["part"], r["n"], bytes(r["model"])) for r in means])
            values = _shaped(flat, values)
    schema = "use string, kind string, label double, out double, n bigint"
    judged = parts.mapInArrow(_judge_function(values), schema)
    counts = judged.groupBy("use", "kind", "label", "out").agg(F.sum("n").alias("n")).toPandas()
    counts = counts.sort_values(["use", "kind", "out"])
    kept, tested = counts[counts["use"] == "kept"], counts[counts["use"] == "tested"]
    columns = [kept[name].to_numpy() for name in ("out", "label", "n")]
    net = calibrated(values, *columns, LEAST_RECALL)
    tested = tested.assign(taken=_sigmoid(net.scale * tested["out"] + net.shift) >= net.threshold)
    return net, {
        kind: (int(rows["n"].sum()), float((rows["n"] * rows["taken"]).sum() / rows["n"].sum()))
        for kind, rows in tested.groupby("kind")
    }


def examples(docs: DataFrame, most: int = PART_WINDOWS) -> Examples | None:
    """The examples of a corpus' first part, to look at, or None where it has no other candidates."""
    parts = window_parts(docs, most)
    if parts is None:
        return None
    first = parts.orderBy("part").limit(1).toArrow().to_pylist()[0]
    return _unpacked(first, np.random.default_rng(SEED))


def fit(held: Examples | None) -> tuple[Network | None, dict[str, tuple[int, float]]]:
    """The network and the report that the examples of one part give alone."""
    if held is None:
        return None, {}
    tested = np.random.default_rng(SEED + 1).random(len(held.rows)) < TESTED
    net = train_network(held.rows[~tested], held.labels[~tested])
    taken = _sigmoid(net.scale * logits(held.rows[tested], net) + net.shift) >= net.threshold
    kinds = held.kinds[tested]
    return net, {kind: (int((kinds == kind).sum()), float(taken[kinds == kind].mean())) for kind in sorted(set(kinds))}


def _scan_function(network):
    def scan(batches):
        net = network.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            bases = [base_findings(text) for text in texts]
            best = [{} for _ in texts]
            for row, text in enumerate(texts if net is not None else []):
                places = [
                    (start, end, at)
                    for start, end in candidates(text, bases[row])
                    for at in windows(text, start, end)
                ]
                for first in range(0, len(places), JUDGED):
                    part = places[first : first + JUDGED]
                    rows = encoded_windows(text, [(at, end) for _, end, at in part])
                    scores = _sigmoid(net.scale * logits(rows, net) + net.shift)
                    for (start, end, _), score in zip(part, scores.tolist(), strict=True):
                        if score >= net.threshold:
                            best[row][start, end] = max(score, best[row].get((start, end), score))
            spans = [
                [(s, k, e, 1.0) for s, k, e in base] + [(s, 3, e, p) for (s, e), p in more.items()]
                for base, more in zip(bases, best)
            ]
            spans = [
                [{"kind": KINDS[k], "start": s, "end": e, "score": p} for s, k, e, p in sorted(found)]
                for found in spans
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(spans, SPANS)], names=["doc_id", "spans"]
            )

    return scan


SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
)


def scan_secrets(
    docs: DataFrame, most: int = PART_WINDOWS, train_on: DataFrame | None = None
) -> DataFrame:
    """(doc_id, spans) for every row of ``docs``; a span has kind, start, end and score.

    Places are code points, the end exclusive; spans are sorted by start, then kind. The patterns'
    findings all stay. Every other token of at least ``LONG_TOKEN`` characters, or of ``LEAST_TOKEN`` with
    a digit and a letter, or what the patterns leave of one, is a candidate. The network judges it
    with its surroundings, at overlapping places over its whole length, whatever that is, of which
    the best score counts; it is trained on all findings of ``train_on``, by default the same corpus,
    and on secrets planted in its texts, where all tokens that no pattern finds are taken for harmless,
    so secrets of other kinds should be few there. A task trains on about ``most`` windows at a time. A null text is empty; a corpus without other candidates has no learned spans. Repeated
    rows each get a result; no rows give no rows.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    learned = rows if train_on is None else train_on
    learned = learned.select(F.coalesce("text", F.lit("")).alias("text"))
    network = docs.sparkSession.sparkContext.broadcast(learn(learned, most)[0])
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, "
    schema += "spans array<struct<kind: string, start: bigint, end: bigint, score: double>>"
    return rows.mapInArrow(_scan_function(network), schema)

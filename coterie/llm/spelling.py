"""Spelling variants: words one edit apart, found in FM-indexes of the vocabulary.

A word one edit away from another keeps one of its halves. Every word is therefore indexed under
the beginnings and endings that a neighbour's half can be, and asks the shards of its own two
halves. A shard holds the text of its words, delimited, as an FM-index of one of two directions:
over the reversed text a search matches the first half and extends over the second, over the text
itself it matches the second half and extends over the first. The half must be exact and the rest
holds one error. A half that many words share is cut into tiles, which all its searches visit.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coterie.llm.buffers import ranges
from coterie.operators.lineage import cut
from coterie.operators.skew import salted_join

WORD_RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH = 6
LEAST_COUNT = 5
TYPO_EVERY = 199
DOMINANCE = 5
TILE_WORDS = 4096
SHARD_WORDS = 1 << 15
SEARCH_WORDS = 1 << 10
DELIMITER = 0

NEAR_ROWS = "word string, near string, near_n bigint"


def word_counts(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    typo_every: int = TYPO_EVERY,
) -> DataFrame:
    """(word, n): the words of whole texts and how often they occur.

    Words are runs of letters with A-Z lower-cased. A run loses one letter where the CRC-32 of
    ``doc_id:run`` is divisible by ``typo_every``, the one that the same number names. Shorter and
    rarer words are left out. Null texts have no words; a null doc_id counts as an empty text.
    """
    found = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all("text", F.lit(WORD_RUN), F.lit(0))).alias("run"),
    ).where(F.length("run") >= least_length)
    lower = F.translate("run", UPPER, LOWER)
    found = found.select("id", F.when(F.col("run").rlike("[A-Z]"), lower).otherwise(F.col("run")).alias("run"))
    number = F.crc32(F.concat("id", F.lit(":"), "run"))
    found = found.select("run", number.alias("number"))
    shorter = F.expr(
        "concat(substring(run, 1, cast(number % length(run) as int)), "
        "substring(run, cast(number % length(run) as int) + 2))"
    )
    word = F.when(F.col("number") % typo_every == 0, shorter).otherwise(F.col("run"))
    return (
        found.select(word.alias("word"))
        .where(F.length("word") >= least_length)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least_count)
    )


class FmIndex:
    """Suffix ranks of a delimited text of words: ``#first#second#``.

    A pattern is an interval of suffix ranks and is extended to the left, one symbol at a time.
    ``word_of[rank]`` is the word after the delimiter of that rank.
    """

    def __init__(self, codes: np.ndarray, lengths: np.ndarray):
        self.alphabet, symbols = np.unique(codes, return_inverse=True)
        n, n_words = len(codes) + len(lengths) + 1, len(lengths)
        firsts = np.cumsum(lengths + 1) - lengths
        text = np.full(n, DELIMITER, np.int64)
        text[ranges(firsts, lengths)] = symbols + 1
        order = self._suffixes(text)
        before = np.where(order > 0, text[order - 1], len(self.alphabet) + 1)
        self.before, self.width = before, n + 1
        # (symbol, rank) of every rank's preceding symbol, sorted: counting is a binary search
        self.places = np.sort(before * self.width + np.arange(n))
        counts = np.bincount(text, minlength=len(self.alphabet) + 1)
        smaller = np.cumsum(counts) - counts
        held = np.bincount(before, minlength=len(self.alphabet) + 2)[: len(counts)]
        # the last delimiter is the first suffix and precedes none
        self.shift = smaller - (np.cumsum(held) - held)
        self.shift[DELIMITER] += 1
        self.n_delimiters = n_words + 1
        start = np.full(n, n_words)
        start[firsts - 1] = np.arange(n_words)
        self.word_of = start[order[: self.n_delimiters]]

    @staticmethod
    def _suffixes(text: np.ndarray) -> np.ndarray:
        """Positions of all suffixes in order, by sorting prefixes of doubling length."""
        n, known, rank = len(text), 1, text
        while True:
            following = np.zeros(n, np.int64)
            following[: n - known] = rank[known:] + 1
            key = rank * (n + 2) + following
            order = np.argsort(key, kind="stable")
            key = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))
            if rank[order[-1]] == n - 1 or known >= n:
                return order
            known *= 2

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """The symbols of letters, -1 for those that no word has."""
        at = np.searchsorted(self.alphabet, codes)
        at = np.minimum(at, len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == codes, at + 1, -1)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """The intervals of the patterns with a symbol put in front."""
        key, shift = symbol * self.width, self.shift[symbol]
        return np.searchsorted(self.places, key + low) + shift, np.searchsorted(self.places, key + high) + shift

    def branches(self, low: np.ndarray, high: np.ndarray):
        """(state, symbol): the letters that precede each interval's suffixes."""
        n_letters = len(self.alphabet)
        wide = high - low > n_letters
        narrow = np.flatnonzero(~wide)
        lengths = (high - low)[narrow]
        state = np.repeat(narrow, lengths)
        symbol = self.before[ranges(low[narrow], lengths)]
        letters = (symbol > DELIMITER) & (symbol <= n_letters)
        seen = np.unique(state[letters] * (n_letters + 1) + symbol[letters])
        wide = np.flatnonzero(wide)
        every = np.arange(1, n_letters + 1)
        return (
            np.concatenate((seen // (n_letters + 1), np.repeat(wide, n_letters))),
            np.concatenate((seen % (n_letters + 1), np.tile(every, len(wide)))),
        )


def one_error_matches(index: FmIndex, codes: np.ndarray, ends: np.ndarray, lengths: np.ndarray, exact: np.ndarray):
    """(query, word): whole words one edit away from a query whose last ``exact`` letters they share.

    ``codes`` holds the letters of all queries, ``ends`` where each one stops.
    """
    symbols = index.symbols(codes)
    query = np.arange(len(ends))
    low, high = np.zeros(len(ends), np.int64), np.full(len(ends), index.n_delimiters)
    left = lengths.copy()

    def step(query, left, low, high):
        """The states that the next letter of the query continues."""
        symbol = symbols[ends[query] - lengths[query] + left - 1]
        known = symbol >= 0
        query, left, low, high = query[known], left[known], low[known], high[known]
        low, high = index.extend(symbol[known], low, high)
        alive = high > low
        return query[alive], left[alive] - 1, low[alive], high[alive]

    for matched in range(int(exact.max(initial=0))):
        going = exact[query] > matched
        waiting = [a[~going] for a in (query, left, low, high)]
        moved = step(query[going], left[going], low[going], high[going])
        query, left, low, high = (np.concatenate(pair) for pair in zip(waiting, moved, strict=True))

    found_query, found_word = [], []
    erring = [[np.zeros(0, np.int64)] * 4]
    while len(query) or any(len(states[0]) for states in erring):
        if len(query):
            state, symbol = index.branches(low, high)
            low_, high_ = index.extend(symbol, low[state], high[state])
            alive = high_ > low_
            state, symbol, low_, high_ = state[alive], symbol[alive], low_[alive], high_[alive]
            erring.append([query[state], left[state], low_, high_])  # a letter more
            own = np.full(len(state), -1)
            inside = left[state] > 0
            at = state[inside]
            own[inside] = symbols[ends[query[at]] - lengths[query[at]] + left[at] - 1]
            other = inside & (own != symbol)
            erring.append([query[state[other]], left[state[other]] - 1, low_[other], high_[other]])
            more = left > 0
            query, left, low, high = query[more], left[more], low[more], high[more]
            erring.append([query, left - 1, low, high])  # a letter less
            query, left, low, high = step(query, left, low, high)
        e_query, e_left, e_low, e_high = (np.concatenate(parts) for parts in zip(*erring, strict=True))
        done = e_left == 0
        low_, high_ = index.extend(np.zeros(int(done.sum()), np.int64), e_low[done], e_high[done])
        whole = high_ > low_
        found_query.append(e_query[done][whole])
        found_word.append(index.word_of[low_[whole]])
        erring = [list(step(e_query[~done], e_left[~done], e_low[~done], e_high[~done]))]
    pairs = np.stack([np.concatenate(found_query), np.concatenate(found_word)]) if found_query else np.zeros((2, 0), int)
    return np.unique(pairs, axis=1)


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return (
        np.frombuffer("".join(words).encode("utf-32-le"), np.uint32),
        np.array([len(word) for word in words], np.int64),
    )


def _near_in_shard(rows: pa.Table) -> pa.Table:
    """The near words that one shard's index holds for its queries."""
    columns = [rows.column(c).to_pylist() for c in ("word", "n", "asks")]
    held = {word: n for word, n, asks in zip(*columns, strict=True) if not asks}
    asking = sorted({word for word, _, asks in zip(*columns, strict=True) if asks})
    from_start = rows.column("from_start")[0].as_py() if rows.num_rows else False
    words = list(held)
    out_word, out_near = [], []
    if words and asking:
        # searches extend to the left: what is matched from the start is read backwards
        index = FmIndex(*_letters([word[::-1] for word in words] if from_start else words))
        for at in range(0, len(asking), SEARCH_WORDS):
            part = asking[at : at + SEARCH_WORDS]
            codes, lengths = _letters([word[::-1] for word in part] if from_start else part)
            exact = lengths // 2 if from_start else lengths - lengths // 2
            query, near = one_error_matches(index, codes, np.cumsum(lengths), lengths, exact)
            out_word += [part[i] for i in query.tolist()]
            out_near += [words[i] for i in near.tolist()]
    return pa.table(
        [pa.array(out_word, pa.string()), pa.array(out_near, pa.string()),
         pa.array([held[word] for word in out_near], pa.int64())],
        names=["word", "near", "near_n"],
    )


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): all pairs of words one edit apart, both ways.

    ``words`` has each word once, with its number ``n``.
    """
    halves = F.expr(
        "concat(transform(array_distinct(array((size - 1) div 2, size div 2, (size + 1) div 2)),"
        "   a -> struct(true as from_start, substring(word, 1, cast(a as int)) as half)),"
        " transform(array_distinct(array(size div 2, (size + 1) div 2, (size + 2) div 2)),"
        "   b -> struct(false as from_start, substring(word, cast(size - b as int) + 1) as half)))"
    )
    own = F.expr(
        "array(struct(true as from_start, substring(word, 1, cast(size div 2 as int)) as half),"
        " struct(false as from_start, substring(word, cast(size div 2 as int) + 1) as half))"
    )
    sized = words.select("word", "n", F.length("word").alias("size"))
    key = F.xxhash64("from_start", "half").alias("key")
    held = cut(sized.select("word", "n", F.inline(halves)).select("word", "n", "from_start", key))
    asked = sized.select("word", "n", F.inline(own)).select("word", "n", "from_start", key)
    # a half that only its own word has is asked by no other
    tiles = held.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    tiles = cut(tiles.withColumn("tiles", F.ceil(F.col("rows") / TILE_WORDS).cast("int")))
    n_shards = max(1, -(-(tiles.agg(F.sum("rows")).first()[0] or 0) // SHARD_WORDS))
    own_tile = F.pmod(F.xxhash64(F.lit("tile"), "word"), F.col("tiles")).cast("int")
    held = salted_join(held, tiles, ["key"], "word").withColumn("tile", own_tile)
    asked = salted_join(asked, tiles, ["key"], "word").withColumn(
        "tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    )
    columns = ["word", "n", "from_start", F.pmod(F.xxhash64("key", "tile"), F.lit(n_shards)).alias("shard")]
    rows = held.select(*columns, F.lit(False).alias("asks")).unionAll(
        asked.select(*columns, F.lit(True).alias("asks"))
    )
    found = rows.groupBy("from_start", "shard").applyInArrow(_near_in_shard, NEAR_ROWS)
    # both halves of some pairs agree, around a letter put between them
    return found.repartition("word").groupBy("word", "near").agg(F.max("near_n").alias("near_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following ``form`` from each word that has one ends.

    Every round doubles the distance followed; numbers grow along it, so it ends.
    """
    pointers = cut(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        onward = pointers.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = cut(salted_join(pointers, onward, ["root"], "word").select("word", "further"))
        if moved.isEmpty():
            return pointers
        pointers = cut(
            pointers.join(moved, "word", "left").select(
                "word", F.coalesce("further", "root").alias("root")
            )
        )


def spelling_variants(words: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every row of ``words`` (word, n).

    ``form`` is the near word of the largest ``n``, ties to the first in code-point order, if that is
    at least ``dominance`` times the word's own; else it and ``form_n`` are null. ``root`` is what
    following forms ends at, the word itself if it has none. No words give no rows.
    """
    words = cut(words.select("word", "n"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    wins = -F.col("best.less") >= F.col("n") * dominance
    forms = cut(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(wins, F.col("best.near")).alias("form"),
            F.when(wins, -F.col("best.less")).alias("form_n"),
        )
    )
    return forms.join(_roots(forms), "word", "left").select(
        *forms.columns, F.coalesce("root", "word").alias("root")
    )

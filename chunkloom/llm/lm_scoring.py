"""LM scoring by a hashed maximum-entropy model with a class-factored softmax.

Every word has a path of classes: the first from its last two bytes, the others from its hash, so that no task needs
the vocabulary to know them.  P(word | context) is the product of P(class | classes before it, context) along the path and of
the word's add-one share among the words of its last class.  Each factor is a softmax over ``WIDTH`` classes of a bias and the sum of
three rows of one hashed table, chosen by the classes before and a feature of the context: the word before (bigram),
the two words before (trigram), and the word before the last alone (skip).  A frequent word counts as itself in a context,
another as one of its ending.  The biases make it a unigram model; then each round adds up, over
its share of the training rows, how often each output was seen and expected with each row of the table (the two terms of the
likelihood's gradient), and moves every weight along it, by a step that does not depend on how the rows are dealt to tasks.
Every training row takes part in one round.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Batches, materialize, remainder, texts, utf8

#: The end of a text, counted as a token; words are never empty.
END = b""
MODULUS, HELD_OUT = 7, 2
#: Words whose counts every task holds; a join counts the others.
HEAD_WORDS = 200_000
#: Classes that a softmax chooses among, a power of two.
WIDTH, WIDTH_BITS = 32, 5
#: Distinct words in a last class, about: the path grows by a class whenever the vocabulary has more.
LEAF_WORDS, MAX_LEVELS = 1 << 13, 4
#: Rows of the weight table, all of WIDTH weights: 8 MB, which each task holds beside its sums.
ROWS = 1 << 16
ENDINGS, ENDING_BITS = 1 << 10, 10
BATCH = 1 << 15
#: Rows of a run that are added one by one.
SHORT_RUN = 6
#: Shares of the rounds, by which the training rows are dealt to them by hash.
SHARES = (3, 1)
#: The step's length, and how many times a row must be met for its weights to move halfway.
RATE, PRIOR = 0.5, 50.0
#: Tokens that a training task takes at least, since each task hands on sums for the whole table.
TASK_TOKENS = 10_000_000
#: Distinct words that a task counts before it hands them on.
COUNTER_WORDS = 400_000
SEED = 42


def words_of(data: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) words of a text and the end token."""
    out = (data or b"").lower().split()
    out.append(END)
    return out


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, c) over all of ``docs``."""

    def rows(batches: Batches):
        counter: Counter[bytes] = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([utf8(list(counter)), pa.array(list(counter.values()), pa.int64())], names=["token", "c"])
            counter.clear()
            return out

        for batch in batches:
            for data in texts(batch, "text"):
                counter.update(words_of(data))
                if len(counter) > COUNTER_WORDS:
                    yield flush()
        if counter:
            yield flush()

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(rows, "token string, c long").groupBy("token").agg(F.sum("c").alias("c"))


def levels_for(distinct: int) -> int:
    """How many classes a path has: 2, or more for a vocabulary that would fill the last classes of so many."""
    n = 2
    while n < MAX_LEVELS and distinct > LEAF_WORDS * WIDTH**n:
        n += 1
    return n


def leaf_column(token: Column, levels: int) -> Column:
    """The last class of a token, from 0: the digits of its path in base WIDTH."""
    bits = WIDTH_BITS * (levels - 1)
    ending = F.shiftrightunsigned(F.xxhash64(F.substring(token.cast("binary"), -2, 2)), 64 - ENDING_BITS)
    rest = F.shiftrightunsigned(F.xxhash64(token), 64 - bits)
    return F.shiftleft(ending.bitwiseAND(F.lit(WIDTH - 1).cast("long")), bits).bitwiseOR(rest)


def _ending(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word[-2:], SEED) >> (64 - ENDING_BITS)


class Words(dict):
    """Word -> its place in the head; for any other, -1 less its ending and the upper bits of its hash."""

    def __init__(self, head: list[bytes]):
        super().__init__(zip(head, range(len(head)), strict=True))
        self.endings: dict[bytes, int] = {}

    def __missing__(self, word: bytes) -> int:
        ending = self.endings.get(word[-2:])
        if ending is None:
            ending = self.endings[word[-2:]] = _ending(word)
        return -1 - (ending << 48 | xxhash.xxh64_intdigest(word, SEED) >> 16)


@dataclass
class Model:
    head: list[bytes]
    counts: np.ndarray
    train_tokens: int
    distinct: int
    #: (c + 1) of all words of each last class, and one for an unseen word.
    leaf_mass: np.ndarray
    levels: int = 2
    rows: int = ROWS
    bias: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray | None = None

    def __post_init__(self):
        if not self.bias:
            for level in range(self.levels):
                mass = self.leaf_mass.reshape(WIDTH**level, WIDTH, -1).sum(axis=2)
                self.bias.append(np.log(mass / mass.sum(axis=1, keepdims=True)).astype(np.float32))

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Last class and context number of each word of the head."""
        bits = WIDTH_BITS * (self.levels - 1)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in self.head), np.uint64, len(self.head))
        endings = np.fromiter(map(_ending, self.head), np.int64, len(self.head))
        leaf = (endings & (WIDTH - 1)) << bits | (hashes >> np.uint64(64 - bits)).astype(np.int64)
        # as many words are contexts of their own as the table can tell apart; 0 is the start of a text
        own = np.arange(len(self.head)) < self.rows // WIDTH
        return leaf, 1 + np.where(own, ENDINGS + np.arange(len(self.head)), endings)


@dataclass
class Coder:
    """Last classes and context numbers of the tokens of joined texts, as a task needs them."""

    model: Model
    words: Words = field(init=False)

    def __post_init__(self):
        self.words = Words(self.model.head)
        self.leaf, self.context = self.model.tables()

    def __call__(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rare = ids < 0
        packed = -1 - ids[rare]
        ending, bits = packed >> 48, WIDTH_BITS * (self.model.levels - 1)
        leaf, context = np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
        leaf[~rare], context[~rare] = self.leaf[ids[~rare]], self.context[ids[~rare]]
        leaf[rare], context[rare] = (ending & (WIDTH - 1)) << bits | (packed & ((1 << 48) - 1)) >> (48 - bits), 1 + ending
        return leaf, context


def _mix(a: np.ndarray, b: np.ndarray | int, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (a.astype(np.uint64) + np.uint64(2)) * np.uint64(0x9E3779B97F4A7C15) + (np.asarray(b).astype(np.uint64) + np.uint64(2 + salt)) * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x94D049BB133111EB)
    return h >> np.uint64(32)


def features(context: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Hashes of the features of each token's context in joined texts; ``first`` marks the tokens that begin one."""
    before = np.concatenate([[0], context[:-1]])
    before[first] = 0
    skip = np.concatenate([[0], before[:-1]])
    skip[first] = 0
    return [_mix(before, 0, 1), _mix(before, skip, 2), _mix(skip, 0, 3)]


def steps(model: Model, leaf: np.ndarray, hashed: list[np.ndarray]):
    """For each class of the paths: (level, classes before, class, rows of the table by feature)."""
    for level in range(model.levels):
        digit = leaf >> (WIDTH_BITS * (model.levels - 1 - level))
        node = digit >> WIDTH_BITS
        yield level, node, digit & (WIDTH - 1), [(_mix(h, node, 5 + level) & np.uint64(model.rows - 1)).astype(np.int64) for h in hashed]


def logits(model: Model, level: int, node: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """What the softmax of each token over the classes of a level takes."""
    z = np.take(model.bias[level], node, axis=0)
    if model.weights is not None:
        for at in rows:
            z += np.take(model.weights, at, axis=0)
    return z


def probabilities(z: np.ndarray) -> np.ndarray:
    np.exp(z, out=z)  # biases are logs of shares and weights are bounded, so nothing overflows
    z /= z.sum(axis=1, keepdims=True)
    return z


def log10_probabilities(model: Model, leaf: np.ndarray, hashed: list[np.ndarray]) -> np.ndarray:
    """log10 of the probability of each token's path, less that of its last class's mass: a word has (c + 1) of it."""
    out = -np.log10(model.leaf_mass[leaf])
    for s in range(0, len(leaf), BATCH):
        part = [h[s : s + BATCH] for h in hashed]
        for level, node, digit, rows in steps(model, leaf[s : s + BATCH], part):
            z = logits(model, level, node, rows)
            own = z[np.arange(len(z)), digit]
            out[s : s + BATCH] += (own - np.log(np.exp(z, out=z).sum(axis=1))) / np.log(10)
    return out


def _run_sums(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sums of the runs of rows that begin at ``begins``: short runs place by place, long ones each at once."""
    sizes = np.diff(np.append(begins, len(values)))
    out = np.take(values, begins, axis=0)
    live = np.flatnonzero(sizes > 1)
    for k in range(1, SHORT_RUN):
        out[live] += np.take(values, begins[live] + k, axis=0)
        live = live[sizes[live] > k + 1]
    ones = np.ones(int(sizes.max(initial=1)), np.float32)
    for i, begin, size in zip(live.tolist(), (begins[live] + SHORT_RUN).tolist(), (sizes[live] - SHORT_RUN).tolist(), strict=True):
        out[i] += ones[:size] @ values[begin : begin + size]
    return out


def _begins(ordered: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))


def gather(model: Model, leaf: np.ndarray, hashed: list[np.ndarray], seen: np.ndarray, expected: np.ndarray) -> None:
    """Add to each row of the table how often each class was seen and expected with it."""
    shares = [np.exp(b) for b in model.bias]
    one = np.int32(1)  # of the tables' type, or numpy adds some 30 times as slowly
    counted = np.zeros(model.rows * WIDTH, np.int32)  # how often each class was seen with each row
    # without weights all tokens after the same classes have the same distribution, so for the first levels it is enough to count those with each row
    after = [np.zeros(model.rows * WIDTH**level, np.int32) for level in (0, 1)] if model.weights is None else []
    for s in range(0, len(leaf), BATCH):
        for level, node, digit, rows in steps(model, leaf[s : s + BATCH], [h[s : s + BATCH] for h in hashed]):
            p = None if model.weights is None else probabilities(logits(model, level, node, rows))
            for at in rows:
                np.add.at(counted, at * WIDTH + digit, one)
                if p is None and level < len(after):
                    np.add.at(after[level], (at << (WIDTH_BITS * level)) + node, one)
                    continue
                if p is not None:
                    order = np.argsort(at.astype(np.uint16), kind="stable") if model.rows <= 1 << 16 else np.argsort(at)  # two bytes are sorted by their digits
                    ordered = at[order]
                    begins = _begins(ordered)
                    expected[ordered[begins]] += _run_sums(np.take(p, order, axis=0), begins)
                    continue
                order = np.argsort(at << (WIDTH_BITS * level) | node)
                ordered, nodes = at[order], node[order]
                begins = _begins(ordered)
                pairs = np.union1d(begins, _begins(nodes))
                n = np.diff(np.append(pairs, len(at)))
                expected[ordered[begins]] += _run_sums(np.take(shares[level], nodes[pairs], axis=0) * n[:, None].astype(np.float32), np.searchsorted(pairs, begins))
    seen += counted.reshape(seen.shape)
    for level, times in enumerate(after):
        expected += times.reshape(model.rows, -1) @ shares[level].astype(np.float64)


def joined_ids(batch_texts: list[bytes | None], known: Words, limit: int = 1 << 18):
    """Groups of texts as (first text, words and ids of each, all ids, starts), so many tokens at a time."""
    group, starts, size, begun = [], [], 0, 0
    for i, data in enumerate(batch_texts):
        words = words_of(data)
        starts.append(size)
        group.append((words, np.fromiter(map(known.__getitem__, words), np.int64, len(words))))
        size += len(words)
        if size >= limit or i == len(batch_texts) - 1:
            yield begun, group, np.concatenate([x for _, x in group]), np.array(starts)
            group, starts, size, begun = [], [], 0, i + 1


def gradient_round(docs: DataFrame, model: Model, tokens: int) -> Model:
    """One step of all weights along the gradient over all of ``docs``: by RATE * log((n * seen / expected + PRIOR) / (n + PRIOR)), where n
    is how often the row was met.  ``tokens`` is about how many ``docs`` holds."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"{kind}{i}" for kind in "se" for i in range(WIDTH)]

    def rows(batches: Batches):
        own = shared.value
        code = Coder(own)
        seen, expected = np.zeros((own.rows, WIDTH), np.float32), np.zeros((own.rows, WIDTH))
        for batch in batches:
            for _, _, ids, starts in joined_ids(texts(batch, "text"), code.words):
                leaf, context = code(ids)
                gather(own, leaf, features(context, starts), seen, expected)
        met = np.flatnonzero(expected.any(axis=1))
        for s in range(0, len(met), 8192):
            at = met[s : s + 8192]
            columns = [pa.array(table[at, i].astype(np.float32)) for table in (seen, expected) for i in range(WIDTH)]
            yield pa.RecordBatch.from_arrays([pa.array(at), *columns], names=["row", *names])

    tasks = max(1, -(-tokens // TASK_TOKENS))
    moved = docs.select("text").coalesce(tasks).mapInArrow(rows, "row long, " + ", ".join(f"{x} float" for x in names))
    summed = moved.groupBy("row").agg(*[F.sum(x).alias(x) for x in names])
    met = sum((F.col(f"s{i}") for i in range(1, WIDTH)), F.col("s0"))
    ratio = lambda i: F.when(F.col(f"e{i}") > 0, F.col(f"s{i}") / F.col(f"e{i}")).otherwise(1.0)
    move = [(RATE * F.log((F.col("n") * ratio(i) + PRIOR) / (F.col("n") + PRIOR))).cast("float").alias(f"w{i}") for i in range(WIDTH)]
    got = summed.withColumn("n", met).select("row", *move).toArrow()  # ROWS rows at most
    shared.destroy()
    weights = np.zeros((model.rows, WIDTH), np.float32) if model.weights is None else model.weights.copy()
    at = got.column("row").to_numpy()
    for i in range(WIDTH):
        weights[at, i] += got.column(f"w{i}").to_numpy()
    return replace(model, weights=weights)


def head_of(counts: DataFrame, most: int) -> tuple[list[bytes], np.ndarray, int]:
    """Tokens of the highest counts, as many as fit into ``most`` with all their ties; and the least such count.

    The threshold comes from a histogram of a few thousand count classes, so no task sorts the vocabulary.
    """
    kind = F.when(F.col("c") < 4096, F.col("c")).otherwise(F.floor(F.log2("c") * 256) + 4096 - 12 * 256).cast("long")
    seen, least = 0, None
    classes = counts.groupBy(kind.alias("k")).agg(F.min("c").alias("least"), F.count("*").alias("n")).toPandas().sort_values("k", ascending=False)
    for floor, n in zip(classes["least"], classes["n"], strict=True):
        if seen + n > most:
            break
        seen, least = seen + n, int(floor)
    if least is None:
        return [], np.zeros(0, np.int64), 1 << 62
    found = counts.where(F.col("c") >= least).select(F.col("token").cast("binary"), "c").toArrow()  # at most ``most`` rows
    pairs = sorted(zip((-found.column("c").to_numpy()).tolist(), found.column("token").to_pylist(), strict=True))
    return [w for _, w in pairs], np.array([-c for c, _ in pairs], np.int64), least


def start_model(counts: DataFrame, head: list[bytes], head_counts: np.ndarray, train_tokens: int, distinct: int, rows: int = ROWS) -> Model:
    """The unigram model of ``counts``, over all its tokens."""
    levels = levels_for(distinct)
    mass = np.ones(WIDTH**levels)  # one for a word that was never seen
    found = counts.groupBy(leaf_column(F.col("token"), levels).alias("leaf")).agg(F.sum(F.col("c") + 1).alias("m")).toPandas()  # a row for each last class
    mass[found["leaf"].to_numpy(np.int64)] += found["m"].to_numpy(np.float64)
    return Model(head, head_counts, train_tokens, distinct, mass, levels, rows)


def train(training: DataFrame, counts: DataFrame, shares: Sequence[int] = SHARES, head_words: int = HEAD_WORDS, rows: int = ROWS) -> tuple[Model, int]:
    """The model of ``training`` (doc_id, text) with its ``counts``, and the least count of a word of its head."""
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    head, head_counts, least = head_of(counts, head_words)
    model = start_model(counts, head, head_counts, total["n"], total["v"], rows)
    place, begun = F.pmod(F.xxhash64(F.lit("round"), "doc_id", "text"), F.lit(max(1, sum(shares)))), 0
    for share in shares if total["n"] else ():
        own = training.where((place >= begun) & (place < begun + share))
        model = gradient_round(own, model, -(-total["n"] * share // sum(shares)))
        begun += share
    return model, least


def score(docs: DataFrame, shares: Sequence[int] = SHARES, head_words: int = HEAD_WORDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null texts count as empty: one token, the end.  Rows whose id is null count as training rows.  Repeated rows are
    scored alike.  Without training rows all counts are 0.  Texts of any length are scored whole, in blocks.  Other columns
    of ``docs`` are not looked at.  The scores do not depend on how ``docs`` is partitioned, but for the rounding of sums.
    """
    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (remainder(F.col("doc_id"), MODULUS) == HELD_OUT).alias("held_out"))
    training = rows_in.where("not held_out")
    counts = materialize(token_counts(training), "lm-counts")
    model, least = train(training, counts, shares, head_words, rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored_rows(batches: Batches):
        own = shared.value
        code = Coder(own)
        logs = np.append(np.log10(own.counts + 1.0), 0.0)  # an unlisted word adds nothing here
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids_in, held = batch.column("doc_id"), batch.column("held_out")
            for begun, group, ids, starts in joined_ids(texts(batch, "text"), code.words):
                leaf, context = code(ids)
                in_head = ids >= 0
                own_logs = logs[np.where(in_head, ids, -1)]
                got = log10_probabilities(own, leaf, features(context, starts)) + own_logs
                sums = [np.add.reduceat(x, starts) for x in (own_logs, got, in_head.astype(np.int64))]
                rare = [Counter(map(words.__getitem__, np.flatnonzero(own_ids < 0).tolist())) for words, own_ids in group]
                sizes = np.array([len(x) for x in rare])
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                pairs = pa.StructArray.from_arrays([utf8([w for x in rare for w in x]), pa.array([n for x in rare for n in x.values()], pa.int64())], ["token", "k"])
                n = len(group)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(number + np.arange(n)),
                        ids_in.slice(begun, n),
                        held.slice(begun, n),
                        pa.array(np.diff(np.append(starts, len(ids)))),
                        pa.array(sums[2]),
                        pa.array(sums[0]),
                        pa.array(sums[1]),
                        pa.ListArray.from_arrays(offsets, pairs),
                    ],
                    names=["row", "doc_id", "held_out", "n_tokens", "n_head", "head_log", "model_log", "rare"],
                )
                number += n

    scored = rows_in.mapInArrow(scored_rows, "row long, doc_id long, held_out boolean, n_tokens long, n_head long, head_log double, model_log double, rare array<struct<token:string,k:long>>")
    scored = materialize(scored, "lm-scored")
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.token", "r.k")
    known = rare.join(counts.where(F.col("c") < least), "token").groupBy("row").agg(F.sum("k").alias("n_rare"), F.sum(F.col("k") * F.log10(F.col("c") + 1)).alias("rare_log"))
    all_rows = scored.drop("rare").join(known, "row", "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return all_rows.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_head") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("head_log") + rare_log - F.col("n_tokens") * F.log10(F.lit(float(model.train_tokens + model.distinct + 1)))).alias("base_score"),
        (F.col("model_log") + rare_log).alias("score"),
    )

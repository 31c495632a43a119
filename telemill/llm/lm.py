"""N-gram language model by deleted interpolation.

P(w | v) = l2(b) c(v w) / c(v) + l1(b) c(w) / N + l0(b) / (V + 1), where b is the bucket of the
context's frequency c(v) (its power of two). Counts are maximum-likelihood counts over all
training texts; the weights of each bucket come from expectation-maximisation on held-out
counts: a fold of the training texts whose own counts are deleted while weights are learned.
The order is two: counts of longer n-grams of a corpus take more disk than the corpus.

Documents are gathered into blocks of bounded size, written once. A block asks for the totals of
its distinct n-grams (sorted hashes, one message per hash range), the range's task adds up all
blocks' counts and answers in the order of the question. So counts grow with the corpus and are
shuffled by n-gram, but no count table is ever broadcast, and a frequent word is one entry per
block. N-grams are identified by 55 bits of a hash.

Null and empty texts are the end token alone. Repeated rows count and are scored each by itself.
Without training texts all counts are 0 and the model is uniform over no words (probability 1).
Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import arrow_map, arrow_schema, as_batch, per_worker, stored, texts

BLOCK = 6_000_000  # bytes of text per block
RANGE = 2_000_000  # tokens per hash range, about
TOP = 1 << 55  # keys are below this; the lowest bit tells words from pairs
CLASSES = 24  # context-frequency buckets
GRID = 4  # steps per octave of the held-out histogram
CACHE = 250_000
STEPS = 100
BASE_ADD = 0.1
_END = np.uint64(0xE7037ED1A0B428DB)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _tokens(text: bytes) -> np.ndarray:
    """Hashes of the words and the end token; of bytes, only A-Z is lowered and ASCII blanks split."""
    words = text.lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(per_worker("lm", _Hashes).__getitem__, words), np.uint64, len(words))
    out[-1] = _END
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _keys(tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of each token, of its context and of the pair; a text's first context is the end token."""
    context = np.concatenate(([_END], tokens[:-1]))
    context[first] = _END
    single = (_mix(tokens) >> np.uint64(9)) | np.uint64(1)
    before = (_mix(context) >> np.uint64(9)) | np.uint64(1)
    with np.errstate(over="ignore"):
        pair = (_mix(_mix(context) * np.uint64(3) + tokens) >> np.uint64(9)) & ~np.uint64(1)
    return single, before, pair


def _packed(values: np.ndarray) -> bytes:
    """Non-negative integers by byte planes, compressed."""
    planes = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    body = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()
    return bytes([planes]) + zstandard.ZstdCompressor(level=1).compress(body)


def _unpacked(blob: bytes) -> np.ndarray:
    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), np.uint8).reshape(blob[0], -1)
    out = np.zeros((body.shape[1], 8), np.uint8)
    out[:, : blob[0]] = body.T
    return out.reshape(-1).view("<u8").copy()


def blocks(docs: DataFrame, fold: Column) -> DataFrame:
    """Blocks of documents: ids, folds, byte lengths and the compressed texts.

    ``fold`` is 0 for texts that aren't learned from, 1 for the held-out fold of the training
    texts, 2 for the others. Texts of fold 1 have blocks of their own.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), fold.cast("int").alias("fold"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"held boolean, ids array<{kind}>, folds array<int>, sizes array<int>, body binary, n_main long, n_held long, n_all long"
    fields = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = {False: [], True: []}
        held_bytes = {False: 0, True: 0}

        def close(held):
            ids, folds, bodies = map(list, zip(*open_[held]))
            n = [len(b.split()) + 1 for b in bodies]
            open_[held], held_bytes[held] = [], 0
            return as_batch({
                "held": [held], "ids": [ids], "folds": [folds], "sizes": [[len(b) for b in bodies]],
                "body": [zstandard.ZstdCompressor(level=3).compress(b"".join(bodies))],
                "n_main": [sum(c for c, f in zip(n, folds) if f == 2)], "n_held": [sum(c for c, f in zip(n, folds) if f == 1)], "n_all": [sum(n)],
            }, fields)

        for batch in batches:
            for doc, text, f in zip(*batch.columns):
                body, f = text.as_py().encode(), f.as_py()
                held = f == 1
                open_[held].append((doc.as_py(), f, body))
                held_bytes[held] += len(body) + 1
                if held_bytes[held] >= BLOCK:
                    yield close(held)
        for held in (False, True):
            if open_[held]:
                yield close(held)

    return stored(rows.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id()), "blocks")


class _Block:
    """A block's tokens with the sorted keys it asks for."""

    def __init__(self, folds, sizes, body: bytes):
        text = zstandard.ZstdDecompressor().decompress(body)
        ends = np.cumsum(sizes)
        each = [_tokens(text[e - s : e]) for s, e in zip(sizes, ends)]
        self.lengths = np.array([len(x) for x in each])
        self.first = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.tokens = np.concatenate(each)
        self.fold = np.repeat(np.asarray(folds), self.lengths)
        self.single, self.before, self.pair = _keys(self.tokens, self.first)
        words, self.word_at = np.unique(self.single, return_inverse=True)
        pairs, self.pair_at = np.unique(self.pair, return_inverse=True)
        self.keys = np.concatenate((words, pairs, [(_mix(np.array([_END])) >> np.uint64(9))[0] | np.uint64(1)]))
        self.keys, place = np.unique(self.keys, return_inverse=True)
        # Places of a token's own key, of its context's and of the pair's among the sorted keys.
        self.word_at, self.pair_at = place[: len(words)][self.word_at], place[len(words) : -1][self.pair_at]
        self.before_at = np.searchsorted(self.keys, self.before)

    def counts(self, fold: int) -> np.ndarray:
        own = self.fold == fold
        n = len(self.keys)
        return np.bincount(self.word_at[own], minlength=n) + np.bincount(self.pair_at[own], minlength=n)


def questions(stored_blocks: DataFrame, ranges: int) -> DataFrame:
    """(block, range, keys, main, held): the sorted keys of each block and its own counts."""

    def work(batch):
        for row in batch.to_pylist():
            block = _Block(row["folds"], row["sizes"], row["body"])
            main, held = block.counts(2), block.counts(1)
            number = _range_of(block.keys, ranges)
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(number)) + 1, [len(number)]))
            spans = list(zip(cuts[:-1], cuts[1:]))
            yield {
                "block": [row["block"]] * len(spans), "range": [int(number[s]) for s, _ in spans],
                "keys": [_packed(np.diff(block.keys[s:e], prepend=np.uint64(0))) for s, e in spans],
                "main": [_packed(main[s:e]) for s, e in spans], "held": [_packed(held[s:e]) for s, e in spans],
            }

    columns = stored_blocks.select("block", "folds", "sizes", "body")
    return arrow_map(columns, work, "block long, range long, keys binary, main binary, held binary")


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return (keys.astype(np.float64) * (ranges / TOP)).astype(np.int64).clip(0, ranges - 1)


def answers(asked: DataFrame) -> DataFrame:
    """(block, range, main, held, words): totals over all blocks in the order asked; block -1 has the
    number of distinct training words of the range."""
    schema = "block long, range long, main binary, held binary, words long"
    fields = arrow_schema(schema)

    def work(table: pa.Table) -> pa.Table:
        keys = [np.cumsum(_unpacked(k), dtype=np.uint64) for k in table["keys"].to_pylist()]
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        totals = []
        for name in ("main", "held"):
            own = np.concatenate([_unpacked(c) for c in table[name].to_pylist()])
            totals.append(np.bincount(at, own.astype(np.float64), minlength=len(distinct)).astype(np.int64))
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        parts = np.split(at, cuts)
        words = int((((distinct & np.uint64(1)) == 1) & (totals[0] + totals[1] > 0)).sum())
        n = len(parts)
        number = table["range"][0].as_py()
        return pa.Table.from_arrays([
            pa.array([*table["block"].to_pylist(), -1]), pa.array([number] * (n + 1)),
            pa.array([*[_packed(totals[0][p]) for p in parts], None], pa.binary()), pa.array([*[_packed(totals[1][p]) for p in parts], None], pa.binary()),
            pa.array([0] * n + [words]),
        ], schema=fields)

    return asked.groupBy("range").applyInArrow(work, schema)


def _met(left: pa.Table, right: pa.Table) -> Iterator[tuple[dict, _Block, np.ndarray, np.ndarray]]:
    """A block with the totals of its keys."""
    if not left.num_rows:
        return
    row = left.to_pylist()[0]
    order = np.argsort(right["range"].to_numpy())
    main, held = ([right[name][int(i)].as_py() for i in order] for name in ("main", "held"))
    yield row, _Block(row["folds"], row["sizes"], row["body"]), *(np.concatenate([_unpacked(b) for b in x]).astype(np.float64) for x in (main, held))


def frequency_class(n: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2 n), up to the last class."""
    return np.where(n > 0, np.minimum(np.floor(np.log2(np.maximum(n, 1))) + 1, CLASSES - 1), 0).astype(np.int64)


def estimates(c_pair, c_before, c_word, n: float, v: float):
    """Maximum-likelihood estimates of the pair, the word, and the uniform one."""
    p2 = np.where(c_before > 0, c_pair / np.maximum(c_before, 1), 0.0)
    return p2, c_word / max(n, 1), 1 / (v + 1)


def held_out(stored_blocks: DataFrame, answered: DataFrame, n: float, v: float) -> DataFrame:
    """Histogram of held-out tokens by context class and the ratios of the estimates to the uniform one."""
    fields = arrow_schema("class int, r2 int, r1 int, n long")

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [np.zeros((0, 4), np.int64)]
        for _, block, main, _ in _met(left, right):
            own = block.fold == 1
            c_before = main[block.before_at[own]]
            p2, p1, p0 = estimates(main[block.pair_at[own]], c_before, main[block.word_at[own]], n, v)
            ratio = lambda p: np.where(p > 0, np.round(GRID * np.log2(np.maximum(p, 1e-300) / p0)), -10_000).astype(np.int64)
            cells, times = np.unique(np.stack([frequency_class(c_before), ratio(p2), ratio(p1)], 1), axis=0, return_counts=True)
            parts.append(np.column_stack((cells, times)))
        out = np.concatenate(parts)
        return pa.Table.from_arrays([pa.array(out[:, k], f.type) for k, f in enumerate(fields)], schema=fields)

    left = stored_blocks.filter("held").select("block", "folds", "sizes", "body")
    right = answered.join(left.select("block"), "block", "left_semi").select("block", "range", "main", "held")
    cells = left.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(work, "class int, r2 int, r1 int, n long")
    return cells.groupBy("class", "r2", "r1").agg(F.sum("n").alias("n"))


def weights(cells: list[tuple[int, int, int, int]], steps: int = STEPS) -> np.ndarray:
    """Mixture weights (pair, word, uniform) per class by expectation-maximisation; one pseudo-count each."""
    out = np.full((CLASSES, 3), 1 / 3)
    out[0] = 0, 0.5, 0.5  # an unseen context has no pair estimate
    if not cells:
        return out
    c, r2, r1, n = np.array(cells, float).T
    p = np.stack([np.where(r2 <= -10_000, 0, 2.0 ** (r2 / GRID)), np.where(r1 <= -10_000, 0, 2.0 ** (r1 / GRID)), np.ones(len(n))], 1)
    for k in range(CLASSES):
        own = c == k
        if not own.any():
            continue
        for _ in range(steps):
            share = p[own] * out[k]
            share /= share.sum(1, keepdims=True)
            total = n[own] @ share + (1 if k else np.array([0, 1, 1]))
            out[k] = total / total.sum()
    seen = [k for k in range(1, CLASSES) if (c == k).any()]
    for k in range(1, CLASSES):  # classes without held-out tokens take the nearest one's weights
        if seen and k not in seen:
            out[k] = out[min(seen, key=lambda s: abs(s - k))]
    return out


def lm_scores(docs: DataFrame, fold: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fold, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``fold`` is a function of the id column named ``doc_id``; see ``blocks``.
    """
    rows = texts(docs, id_col, text_col)
    kept = blocks(rows, fold)
    n_main, n_held, n_all = kept.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_main", "n_held", "n_all")]).first()
    answered = stored(answers(questions(kept, n_all // RANGE + 1)), "answers")
    n, v = n_main + n_held, answered.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    cells = [tuple(r) for r in held_out(kept, answered, n_main, v).collect()]  # bounded by classes x grid
    mix = weights(cells)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, fold int, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    fields = arrow_schema(schema)

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row, block, main, held in _met(left, right):
            total = main + held
            c_word, c_before = total[block.word_at], total[block.before_at]
            p2, p1, p0 = estimates(total[block.pair_at], c_before, c_word, n, v)
            w = mix[frequency_class(c_before)]
            each = np.log10(w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] * p0)
            base = np.log10((c_word + BASE_ADD) / (n + BASE_ADD * (v + 1)))
            summed = lambda x: np.add.reduceat(x, block.first)
            out.append(as_batch({
                "doc_id": row["ids"], "fold": row["folds"], "n_tokens": block.lengths, "n_known": summed((c_word > 0).astype(np.int64)),
                "train_tokens": [n] * len(block.lengths), "base_score": summed(base), "score": summed(each),
            }, fields))
        return pa.Table.from_batches(out, schema=fields)

    left = kept.select("block", "ids", "folds", "sizes", "body")
    right = answered.filter("block >= 0").select("block", "range", "main", "held")
    return left.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(work, schema)


def perplexity(scored: DataFrame) -> DataFrame:
    """Per fold: tokens, and the perplexities of the base and of the model."""
    power = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("fold").agg(F.sum("n_tokens").alias("n_tokens"), power("base_score").alias("base"), power("score").alias("model"))

"""Token counts by the whole-token shortcut.

A text is cut into pre-tokens at places that no vocabulary string spans, so that the merges of
one pre-token never depend on its neighbours. ``proven`` derives this from the vocabulary and
collects the strings that the library encodes as one token; those are counted by lookup. Other
pre-tokens are merged by the library, once per worker while they stay in a bounded cache.

Null and empty texts have 0 tokens. Repeated rows are counted each by itself; only the id and
text columns are read.
"""

from __future__ import annotations

import re

import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from telemill.llm.common import arrow_map, per_worker, strings, texts

SPACE = "▁"  # how the vocabulary writes a blank (fixed value)
CACHE = 400_000  # merged pre-tokens kept per worker


def proven(model_path: str) -> tuple[sentencepiece.SentencePieceProcessor, re.Pattern, dict[str, int]]:
    """The processor, the pre-token pattern and the pre-tokens of exactly one token.

    Raises when the vocabulary doesn't allow the cuts: a piece with a blank after another
    character, or a text normalisation other than the identity.
    """
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    plain = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i))]
    pieces = {sp.id_to_piece(i): i for i in plain}
    if any(SPACE in p.lstrip(SPACE) for p in pieces):
        raise ValueError("a vocabulary string spans a word boundary")
    probe = "Åﬁ  Á\t　x "
    if sp.decode(sp.encode(probe)) != probe:
        raise ValueError("the model normalises its input")
    alone = "".join(c for c in "\n\t\r" if not any(c in p for p in pieces) and len(sp.encode(c)) == 2)
    if "\n" not in alone:
        raise ValueError("a line end isn't a token of its own")
    pattern = re.compile(f" *[^ {re.escape(alone)}]+|[{re.escape(alone)}]| +")
    # A line end before the pre-token keeps the model's own leading blank away from it.
    single = [(p, i) for p, i in pieces.items() if pattern.fullmatch(p.replace(SPACE, " "))]
    coded = sp.encode(["\n" + p for p, _ in single])
    whole = {p.replace(SPACE, " "): 1 for (p, i), ids in zip(single, coded) if len(ids) == 3 and ids[2] == i}
    return sp, pattern, whole | dict.fromkeys(alone, 1)


class _Counts(dict):
    """Tokens by pre-token: the proven ones, and merged ones while there is room."""

    def __init__(self, sp, whole):
        super().__init__(whole)
        self.sp, self.whole = sp, whole

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
            self.update(self.whole)
        n = self[word] = len(self.sp.encode("\n" + word)) - 2
        return n


def _tools(model_path: str):
    sp, pattern, whole = proven(model_path)
    return pattern.findall, _Counts(sp, whole)


def count(text: str, model_path: str) -> int:
    cut, counts = per_worker(("tokens", model_path), lambda: _tools(model_path))
    if not text:
        return 0
    return sum(map(counts.__getitem__, cut(" " + text.replace(SPACE, " "))))


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row, in one pass without a shuffle."""

    def work(batch):
        n = [count(t, model_path) for t in strings(batch.column(1))]
        size = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast("int64")
        yield {"doc_id": batch.column(0), "n_bytes": size, "n_tokens": n, "over_limit": [x > limit for x in n]}

    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return arrow_map(rows, work, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")

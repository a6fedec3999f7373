"""Exact token counts of every prefix of a text, by dynamic programming over prefixes.

For a merging tokenizer the tokens of a prefix are the tokens of a shorter prefix and one last token, so a table of
the last token and the count at every prefix is filled from left to right: the last token of a prefix is the one piece
that ends there, is reachable by merges, and is not merged with the last token before it. The table answers how many
tokens any prefix has, and where a text has to be cut for a budget, without encoding anything again.

The model is a sentencepiece one of the merging kind, with byte fallback, an identity normaliser and a space in front of
the text. No piece crosses from other characters into a space, so the table is made per word and joined; each task
keeps the tables of words that it has seen, up to a number of them.

Defined results: a null or empty text has 0 tokens. Repeated rows are counted alike and kept. Special strings inside
a text are ordinary text, which is the library's default.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.llm.common import doc_texts, steps

SPACE = "▁"
MAX_WORDS = 400_000
# Longer words, as of texts without blanks, are not kept: so the caches hold some 100 MB at most.
MAX_KEPT = 48
_UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_TABLES: dict[str, PrefixTable] = {}


class PrefixTable:
    """Counts at every prefix, for one model."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usual = [
            i
            for i in range(model.vocab_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        # The merge of the highest score comes first.
        names = [model.id_to_piece(i) for i in sorted(usual, key=lambda i: (-model.get_score(i), i))]
        self.rank = {name: i for i, name in enumerate(names)}
        if any(re.search(f"[^{SPACE}]{SPACE}", name) for name in names):
            raise ValueError(f"{path} has pieces that cross words")
        if model.encode(" a", out_type=str) != model.encode(SPACE + "a", out_type=str) or model.encode(""):
            raise ValueError(f"{path} has another normaliser than the one expected here")
        self.longest = max(map(len, names))
        # Characters that stand side by side in some piece: elsewhere a word can be cut.
        self.seams = {name[i : i + 2] for name in names for i in range(len(name) - 1)}
        self._split: dict[str, tuple[str, str] | None] = {}
        # Pieces that merges can reach.
        self.alone = {name for name in names if len(name) == 1 or self._halves(name)}
        self._apart: dict[tuple[str, str], bool] = {}
        self._words: dict[str, bytes] = {}
        self._parts: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> PrefixTable:
        if path not in _TABLES:
            _TABLES[path] = cls(path)
        return _TABLES[path]

    def _halves(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge makes a piece; None for a piece that no merge makes."""
        if piece not in self._split:
            parts, rank = list(piece), self.rank
            while len(parts) > 2:
                ranks = [rank.get(a + b, len(rank)) for a, b in zip(parts, parts[1:], strict=False)]
                best = min(ranks)
                if best >= rank[piece]:
                    break
                at = ranks.index(best)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self._split[piece] = tuple(parts) if len(parts) == 2 else None
        return self._split[piece]

    def _is_apart(self, left: str, right: str) -> bool:
        """Whether two pieces stay as they are side by side: no merge across the seam comes before those that made them.

        The merges that made the pieces are undone, latest first. Of equal merges the left one comes first.
        """
        rank, most = self.rank, len(self.rank)
        limit = most
        a, b = left, right
        while True:
            if rank.get(a + b, most) < limit:
                return False
            age_a = rank[a] if len(a) > 1 else -1
            age_b = rank[b] if len(b) > 1 else -1
            if age_a < 0 and age_b < 0:
                return True
            if age_a > age_b:
                limit, a = age_a, self._halves(a)[1]
            else:
                limit, b = age_b + 1, self._halves(b)[0]

    def steps_of(self, word: str) -> bytes:
        """By how much the count changes with each character of a word, as signed bytes."""
        found = self._words.get(word)
        if found is None:
            if len(self._words) > MAX_WORDS:
                self._words.clear()
            cuts = [i for i in range(1, len(word)) if word[i - 1 : i + 1] not in self.seams]
            parts = [word[i:j] for i, j in zip([0, *cuts], [*cuts, len(word)], strict=True)]
            found = b"".join([self._parts.get(p) or self._steps_of_part(p) for p in parts])
            if len(word) <= MAX_KEPT:
                self._words[word] = found
        return found

    def _steps_of_part(self, part: str) -> bytes:
        if len(self._parts) > MAX_WORDS:
            self._parts.clear()
        found = self._fill(part)
        if len(part) <= MAX_KEPT:
            self._parts[part] = found
        return found

    def _fill(self, word: str) -> bytes:
        alone, apart, longest = self.alone, self._apart, self.longest
        if len(apart) > MAX_WORDS:
            apart.clear()
        last, count = [""], [0]
        for end in range(1, len(word) + 1):
            for start in range(max(0, end - longest), end):
                piece = word[start:end]
                if piece not in alone:
                    continue
                if start:
                    pair = last[start], piece
                    fits = apart.get(pair)
                    if fits is None:
                        fits = apart[pair] = self._is_apart(*pair)
                    if not fits:
                        continue
                last.append(piece)
                count.append(count[start] + 1)
                break
            else:  # A character without a piece: its bytes.
                last.append(word[end - 1])
                count.append(count[end - 1] + len(word[end - 1].encode()))
        return bytes([(b - a) & 255 for a, b in zip(count, count[1:], strict=False)])

    def counts(self, text: str) -> np.ndarray:
        """Tokens of text[:i], for every i from 0 to len(text)."""
        if not text:
            return np.zeros(1, np.int64)
        if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            words = _UNIT.findall(SPACE + text.replace(" ", SPACE))
        else:
            words = [SPACE + word for word in text.split(" ")]
        known = self._words
        changes = b"".join([known.get(word) or self.steps_of(word) for word in words])
        counts = np.cumsum(np.frombuffer(changes, np.int8), dtype=np.int64)
        counts[0] = 0  # the space in front is no character of the text
        return counts


def cut_at(counts: np.ndarray, budget: int) -> int:
    """Length of the longest prefix within the budget."""
    return int(np.flatnonzero(counts <= budget)[-1])


def token_counts(docs: DataFrame, model: str, budget: int, keep_table: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, and cut_chars: the longest prefix within the budget, in code points.

    With keep_table also prefix_tokens: the counts at all prefixes, 0 included, as unsigned 32-bit little-endian
    numbers; `tokens_of_prefix` reads it.
    """
    kept = ", prefix_tokens binary" if keep_table else ""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PrefixTable.of(model)
        for step in steps(batches):
            sizes, tokens, cuts, tables = [], [], [], []
            for text in step.column("text").to_pylist():
                counts = table.counts(text)
                sizes.append(len(text.encode()))
                tokens.append(int(counts[-1]))
                cuts.append(cut_at(counts, budget) if counts[-1] > budget else len(text))
                if keep_table:
                    tables.append(counts.astype("<u4").tobytes())
            out = {
                "doc_id": step.column("doc_id"),
                "n_bytes": pa.array(sizes, pa.int64()),
                "n_tokens": pa.array(tokens, pa.int64()),
                "over_limit": pa.array([n > budget for n in tokens], pa.bool_()),
                "cut_chars": pa.array(cuts, pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(out | ({"prefix_tokens": pa.array(tables, pa.binary())} if keep_table else {}))

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, cut_chars long" + kept
    return doc_texts(docs).mapInArrow(count, schema)


def tokens_of_prefix(table: Column, chars: Column) -> Column:
    """Tokens of the first chars code points, from a kept table."""
    four = F.reverse(F.substring(F.hex(table), chars * 8 + 1, F.lit(8)))
    # Little-endian: the hexadecimal digits are turned around, and then again within each byte.
    bytes_turned = F.regexp_replace(four, "(.)(.)", "$2$1")
    return F.conv(bytes_turned, 16, 10).cast("long")

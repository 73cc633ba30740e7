"""Token counts that follow edits: a tree of pre-token counts per document.

A byte-pair tokenizer first cuts a text into pre-tokens and never merges across them,
so a count is a sum over pre-tokens.  ``TokenTree`` keeps blocks of pre-tokens as the
leaves of a tree of sums (characters and tokens).  An edit cuts anew from one
pre-token before the edited place until a new border meets an old one: from there on
the old cuts hold.  Only the leaves in between and the sums above them change.  Edits
of one text are taken in one sweep; those that lie close together share a run.

Nulls and empty texts have no tokens.  Texts are read whole; repeated rows are counted
each; columns other than id and text are not read.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Callable, Iterable

import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partyard.llm.common import column, map_columns
from partyard.llm.pii import LABELS, find_entities

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# FIXED VALUE: the pre-token pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK = 64

Edit = tuple[int, int, str]


class PieceCounts(dict):
    """Tokens per pre-token, remembered; the encoder is built once per task."""

    def __init__(self, vocabulary: bytes, pattern: str = PATTERN, most: int = 300_000) -> None:
        super().__init__()
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.encoding = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern, self.most = regex.compile(pattern), most

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.most:
            self.clear()
        n = self[piece] = len(self.encoding.encode_ordinary(piece))
        return n


class TokenTree:
    """Pre-token lengths and token counts of one text, in blocks below a tree of sums."""

    def __init__(self, text: str, counts: PieceCounts) -> None:
        self.text, self.counts = text, counts
        self.reencoded = 0
        pieces = counts.pattern.findall(text)
        self._build(list(map(len, pieces)), list(map(counts.__getitem__, pieces)))

    def _build(self, lengths: list[int], tokens: list[int]) -> None:
        self.lengths = [lengths[i : i + BLOCK] for i in range(0, len(lengths), BLOCK)] or [[]]
        self.tokens = [tokens[i : i + BLOCK] for i in range(0, len(tokens), BLOCK)] or [[]]
        self.leaves = 1 << (len(self.lengths) - 1).bit_length()
        self.chars_sum = [0] * (2 * self.leaves)
        self.tokens_sum = [0] * (2 * self.leaves)
        self.emptied = 0
        for i, (a, b) in enumerate(zip(self.lengths, self.tokens, strict=True)):
            self.chars_sum[self.leaves + i], self.tokens_sum[self.leaves + i] = sum(a), sum(b)
        for i in range(self.leaves - 1, 0, -1):
            self._add_up(i)

    @property
    def n_tokens(self) -> int:
        return self.tokens_sum[1]

    @property
    def n_pieces(self) -> int:
        return sum(map(len, self.lengths))

    def _add_up(self, i: int) -> None:
        self.chars_sum[i] = self.chars_sum[2 * i] + self.chars_sum[2 * i + 1]
        self.tokens_sum[i] = self.tokens_sum[2 * i] + self.tokens_sum[2 * i + 1]

    def _locate(self, place: int) -> tuple[int, int]:
        """Block that holds the character, and where the block starts; empty subtrees are passed."""
        i, start = 1, 0
        while i < self.leaves:
            i *= 2
            if place >= start + self.chars_sum[i]:
                start += self.chars_sum[i]
                i += 1
        return i - self.leaves, start

    def _piece_at(self, place: int) -> tuple[int, int, int]:
        """Block, index and start of the pre-token that holds the character."""
        block, at = self._locate(place)
        index = 0
        while at + self.lengths[block][index] <= place:
            at += self.lengths[block][index]
            index += 1
        return block, index, at

    def _restart(self, place: int) -> tuple[int, int, int]:
        """Block, index and start of the pre-token before the one that holds ``place``."""
        if not self.text:
            return 0, 0, 0
        block, index, at = self._piece_at(place)
        return self._piece_at(at - 1) if at else (block, index, at)

    def _apart(self, old: int, start: int) -> bool:
        """Does an edit at ``start`` cut anew from the old border or later?  At the very start none does."""
        at = self._restart(max(start - 1, 0))[2]
        return at >= old and at > 0

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace the characters from ``start`` to ``end``."""
        self.edit_all([(start, end, new)])

    def edit_all(self, edits: Iterable[Edit]) -> None:
        """Apply edits, given by rising place and without overlap, in one sweep.

        Every stretch of edits whose surroundings touch is encoded again as one run, so
        the work grows with the text between and in the edits, however many there are.
        """
        edits = list(edits)
        if not edits:
            return
        fresh = apply_edits(self.text, edits)
        runs, k, shift = [], 0, 0
        while k < len(edits):
            first_block, first, at = self._restart(max(edits[k][0] - 1, 0))
            block, index, old = first_block, first, at  # the next old pre-token and its start
            border = settled = at + shift
            lengths: list[int] = []
            tokens: list[int] = []
            matches = self.counts.pattern.finditer(fresh, border)
            started, ended = False, False
            while True:
                # Take in the first edit, those the new border has passed, and at the end all.
                while k < len(edits) and (not started or ended or border > edits[k][0] + shift):
                    start, end, new = edits[k]
                    settled = start + shift + len(new)
                    shift += len(new) - (end - start)
                    started, k = True, k + 1
                if ended or border >= settled:
                    block, index, old = self._skip(block, index, old, border - shift)
                    if ended or old == border - shift and (k == len(edits) or self._apart(old, edits[k][0])):
                        break
                match = next(matches, None)
                if match is None:
                    ended = True
                    continue
                lengths.append(match.end() - match.start())
                tokens.append(self.counts[match[0]])
                border = match.end()
            self.reencoded += len(lengths)
            runs.append((first_block, first, block, index, lengths, tokens))
        self.text = fresh
        self._replace(runs)

    def _skip(self, block: int, index: int, old: int, place: int) -> tuple[int, int, int]:
        """Past the old pre-tokens that end at or before the place."""
        while block < len(self.lengths):
            if index >= len(self.lengths[block]):
                block, index = (len(self.lengths) if old >= self.chars_sum[1] else self._locate(old)[0]), 0
            elif old + self.lengths[block][index] <= place:
                old += self.lengths[block][index]
                index += 1
            else:
                break
        return block, index, old

    def _replace(self, runs: list[tuple[int, int, int, int, list[int], list[int]]]) -> None:
        """Put new pre-tokens in the place of old ones, last run first, and sum up anew."""
        changed: set[int] = set()
        for first_block, first, block, index, lengths, tokens in reversed(runs):
            for pieces, new in ((self.lengths, lengths), (self.tokens, tokens)):
                after = pieces[block][index:] if block < len(pieces) else []
                if block == first_block:
                    pieces[block] = pieces[block][:first] + new + after
                    continue
                pieces[first_block] = pieces[first_block][:first] + new
                for b in range(first_block + 1, min(block, len(pieces))):
                    pieces[b] = []
                if block < len(pieces):
                    pieces[block] = after
            changed.update(range(first_block, min(block, len(self.lengths) - 1) + 1))
        self.emptied += sum(1 for b in changed if not self.lengths[b] and self.chars_sum[self.leaves + b])
        if max(len(self.lengths[b]) for b in changed) > 4 * BLOCK or 2 * self.emptied > len(self.lengths):
            # Leaves have grown or emptied too much: deal the pre-tokens out again.
            self._build([n for b in self.lengths for n in b], [n for b in self.tokens for n in b])
            return
        nodes = {self.leaves + b for b in changed}
        for i in nodes:
            self.chars_sum[i] = sum(self.lengths[i - self.leaves])
            self.tokens_sum[i] = sum(self.tokens[i - self.leaves])
        while nodes := {i >> 1 for i in nodes if i > 1}:
            for i in nodes:
                self._add_up(i)


def cleaning_edits(text: str) -> list[Edit]:
    """Edits that mask personal data and take out lines which repeat an earlier one."""
    edits: list[Edit] = []
    seen: set[str] = set()
    at = 0
    for line in text.split("\n"):
        if line.strip():
            if line in seen:
                edits.append((at, min(at + len(line) + 1, len(text)), ""))
            seen.add(line)
        at += len(line) + 1
    starts, ends = [e[0] for e in edits], [e[1] for e in edits]
    for kind, s, e in find_entities(text):
        k = bisect_right(starts, s) - 1
        if k < 0 or ends[k] <= s:
            edits.append((s, e, LABELS[kind]))
    kept, until = [], 0
    for edit in sorted(edits):
        if edit[0] >= until:
            kept.append(edit)
            until = edit[1]
    return kept


def apply_edits(text: str, edits: Iterable[Edit]) -> str:
    pieces, at = [], 0
    for s, e, new in edits:
        pieces += [text[at:s], new]
        at = e
    return "".join([*pieces, text[at:]])


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    edits: Callable[[str], list[Edit]] = cleaning_edits,
) -> DataFrame:
    """Tokens of every document before and after its edits; no shuffle.

    ``edits`` gives (start, end, new text) by rising place.  ``n_reencoded`` counts the
    pre-tokens that the edits made the tree look at again.
    """
    raw = docs.select(F.col(id_col).cast("long").alias("doc_id"), column(docs, text_col, "string").alias("text"))
    with open(vocabulary, "rb") as f:
        ranks = f.read()
    names = ("n_chars", "n_pieces", "n_tokens", "n_edits", "n_tokens_edited", "n_reencoded")

    def make():
        counts = PieceCounts(ranks)

        def one(text: str) -> tuple[int, ...]:
            tree = TokenTree(text, counts)
            before = len(text), tree.n_pieces, tree.n_tokens
            found = edits(text)
            tree.edit_all(found)
            return *before, len(found), tree.n_tokens, tree.reencoded

        def work(rows):
            done = [one(t or "") for t in rows["text"]]
            return {"doc_id": rows["doc_id"]} | {n: [d[k] for d in done] for k, n in enumerate(names)}

        return work

    return map_columns(raw, "doc_id long, " + ", ".join(f"{n} long" for n in names), make)


__all__ = ["TokenTree", "apply_edits", "cleaning_edits", "count_tokens"]

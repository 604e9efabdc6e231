"""SentencePiece encoding by a forward pass that words with a common prefix share."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from sentencepiece import SentencePieceProcessor

MARK = "▁"
#: Encoded words that a worker remembers; of more, the half first met stays, which are the most
#: frequent ones.  Forgetting costs time only, as it does for pairs of pieces.
REMEMBERED = 300_000
PAIRS = 150_000
#: Documents whose ids a task hands on at a time.
OUT_ROWS = 2_000
#: Characters of text that are divided into words at a time.
AT_ONCE = 2_000_000
#: Alphabets of the model that are told apart; characters of smaller ones count as one alphabet.
ALPHABETS = 4

_models: dict[str, PieceModel] = {}


def _parts(pieces: Iterable[str]) -> re.Pattern[str]:
    """Pattern of the parts that merging never joins, in texts that have spaces for marks.

    Characters that stand beside each other in a piece belong to one alphabet.  No piece crosses
    from one alphabet to the next, so spaces and the run of one alphabet after them are merged
    alone; so is a character that is in no longer piece.
    """
    root: dict[str, str] = {}

    def find(c: str) -> str:
        while root.setdefault(c, c) != c:
            c = root[c]
        return c

    bodies = (piece.lstrip(MARK) for piece in pieces)
    for a, b in {pair for body in bodies for pair in zip(body, body[1:], strict=False)}:
        root[find(a)] = find(b)
    alphabets: dict[str, str] = {}
    for c in sorted(root.keys() - {" "}):
        alphabets[find(c)] = alphabets.get(find(c), "") + c
    ordered = sorted(alphabets.values(), key=len, reverse=True)
    runs = [*ordered[:ALPHABETS], "".join(ordered[ALPHABETS:])]
    kinds = [f"[{re.escape(run)}]+" for run in runs if run]
    kinds.append(f"[^ {re.escape(''.join(root))}]")
    return re.compile(f" *(?:{'|'.join(kinds)})| +")


class PieceModel:
    """A SentencePiece BPE vocabulary as a forward pass over a trie of words.

    Merging never joins what its result keeps apart, so the pieces of a prefix that ends where a
    piece ends are that prefix's own result.  The forward state of a prefix is therefore its last
    piece: of the pieces that end there, the only one that merging leaves beside the last piece of
    the prefix before it.  Two pieces stand beside each other if no merge across their border
    comes before the merges that made them, which their edges tell.
    """

    def __init__(self, path: str):
        library = SentencePieceProcessor(model_file=path)
        size = library.get_piece_size()
        special = [
            i
            for i in range(size)
            if library.is_byte(i) or library.is_control(i) or library.is_unknown(i) or library.is_unused(i)
        ]
        normal = sorted(set(range(size)) - set(special), key=lambda i: (-library.get_score(i), i))
        self.id = {library.id_to_piece(i): i for i in normal}
        #: Order in which merges are taken; characters need none.
        self.rank = {library.id_to_piece(i): r for r, i in enumerate(normal)}
        if any(MARK in x.lstrip(MARK) for x in self.id):
            raise ValueError("a piece goes on past the end of a word")
        self.parts = _parts(self.id)
        self.byte = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.coded = {piece: i.to_bytes(4, "little") for piece, i in self.id.items()}
        self.edges: dict[str, tuple] = {}
        for piece in sorted(self.id, key=len):
            self._derive(piece)
        #: Pieces that merging can make and all characters of pieces, and their numbers.
        self.names = sorted({*self.edges, *"".join(self.id)})
        self.numbers = {piece: i for i, piece in enumerate(self.names)}
        #: By two and three last characters, lengths and numbers of the pieces that can end with them,
        #: shortest first; longer pieces have no number here, as these characters do not tell them.
        ends: dict[str, set[int]] = {}
        for piece in self.edges:
            if len(piece) > 1:
                ends.setdefault(piece[-3:], set()).add(len(piece))
        self.ends = {
            tail: tuple(
                (n, self.numbers[tail[-n:]] if n <= 3 else None)
                for n in sorted(lengths | ({2} if tail[-2:] in self.edges else set()))
            )
            for tail, lengths in ends.items()
        }
        table = [library.id_to_piece(i).replace(MARK, " ").encode() for i in range(size)]
        for b, i in enumerate(self.byte):
            table[i] = bytes([b])
        for i in special:
            if library.is_control(i):
                table[i] = b""
            elif library.is_unknown(i):
                table[i] = " ⁇ ".encode()
        self.bytes = table
        self.known: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}

    def _derive(self, piece: str) -> None:
        """Note the pieces on both edges of a piece, innermost first, if merging can make it."""
        if len(piece) == 1:
            self.edges[piece] = ((piece,), (-1,), (piece,), (-1,))
            return
        parts = self.merge(piece, stop=piece)
        if len(parts) != 2:
            return
        left, right = parts
        ends, end_ranks = self.edges[right][:2] if right in self.edges else ((right,), (-1,))
        starts, start_ranks = self.edges[left][2:] if left in self.edges else ((left,), (-1,))
        rank = self.rank[piece]
        self.edges[piece] = (*((*ends, piece), (*end_ranks, rank)), *((*starts, piece), (*start_ranks, rank)))

    def merge(self, word: str, stop: str | None = None) -> list[str]:
        """Plain merging, lowest rank and then leftmost first, up to but without making ``stop``."""
        parts = list(word)
        while len(parts) > 1:
            joined = [a + b for a, b in zip(parts, parts[1:], strict=False)]
            ranked = [(self.rank[x], i) for i, x in enumerate(joined) if x in self.rank and x != stop]
            if not ranked:
                break
            i = min(ranked)[1]
            parts[i : i + 2] = [joined[i]]
        return parts

    def beside(self, left: str, right: str) -> bool:
        """Whether merging keeps these two pieces apart."""
        a, b = self.edges.get(left), self.edges.get(right)
        ends, end_ranks = a[:2] if a else ((left,), (-1,))
        starts, start_ranks = b[2:] if b else ((right,), (-1,))
        rank = self.rank
        i, j, last_i, last_j = 0, 0, len(ends) - 1, len(starts) - 1
        never = len(rank)
        while True:
            made = end_ranks[i + 1] if i < last_i else never
            made_right = start_ranks[j + 1] if j < last_j else never
            across = rank.get(ends[i] + starts[j], never)
            # of equal merges the leftmost comes first: the left piece's, then the one across
            if across < made and across <= made_right and across < never:
                return False
            if made == never and made_right == never:
                return True
            if made <= made_right:
                i += 1
            else:
                j += 1

    def encode_words(self, words: Iterable[str]) -> dict[str, list[str]]:
        """Pieces of distinct words."""
        return dict(self._passed(words))

    def _passed(self, words: Iterable[str]) -> Iterator[tuple[str, list[str]]]:
        """Words and their pieces; the words are sorted and traversed as a trie, depth first.

        ``last[i]`` is the number of the last piece of the present word's first i characters, -1 for
        the start and for characters that no piece holds; a word keeps the states of the prefix that
        it shares with the word before.  Only one of the pieces that end at i can be the last one,
        so the short ones, which are found more often, are tried first.
        """
        last = [-1]
        before = ""
        ends, numbers, pairs, base = self.ends, self.numbers, self.pairs, len(self.names)
        for word in sorted(words):
            shared = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :]
            for i in range(shared + 1, len(word) + 1):
                tail = ends.get(word[i - 3 : i]) if i > 2 else None
                for n, right in tail or ends.get(word[i - 2 : i] if i > 2 else word[:i], ()):
                    if right is None:
                        if n > i:
                            continue
                        right = numbers.get(word[i - n : i])
                        if right is None:
                            continue
                    left = last[i - n]
                    if left < 0:
                        break
                    pair = left * base + right
                    apart = pairs.get(pair)
                    if apart is None:
                        if len(pairs) >= PAIRS:
                            pairs.clear()
                        apart = pairs[pair] = self.beside(self.names[left], self.names[right])
                    if apart:
                        break
                else:
                    right = numbers.get(word[i - 1], -1)
                last.append(right)
            pieces, at = [], len(word)
            while at:
                start = at - (len(self.names[last[at]]) if last[at] >= 0 else 1)
                pieces.append(word[start:at])
                at = start
            yield word, pieces[::-1]
            before = word

    def _ids(self, pieces: list[str]) -> bytes:
        coded = self.coded
        try:
            return b"".join([coded[piece] for piece in pieces])
        except KeyError:
            return b"".join([coded.get(piece) or self._spelt(piece) for piece in pieces])

    def _spelt(self, piece: str) -> bytes:
        return np.array([self.byte[b] for b in piece.encode("utf-8")], "<u4").tobytes()

    def _part(self, texts: list[str]) -> Iterator[bytes]:
        divide = self.parts.findall
        words = [divide(" " + text.replace(MARK, " ")) if text else [] for text in texts]
        wanted: set[str] = set()
        for w in words:
            wanted.update(w)
        missing = wanted.difference(self.known)
        if len(self.known) + len(missing) > REMEMBERED:
            self.known = dict(islice(self.known.items(), REMEMBERED // 2))
            missing = wanted.difference(self.known)
        for word, pieces in self._passed(word.replace(" ", MARK) for word in missing):
            self.known[word.replace(MARK, " ")] = self._ids(pieces)
        known = self.known.__getitem__
        for w in words:
            yield b"".join(map(known, w))

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers; null gives none."""
        waiting: list[str] = []
        size = 0
        for text in texts:
            waiting.append(text or "")
            size += len(waiting[-1])
            if size >= AT_ONCE:
                yield from self._part(waiting)
                waiting, size = [], 0
        yield from self._part(waiting)

    def decode(self, ids: bytes) -> str:
        """The text of the ids, without the space that marks its start."""
        table = self.bytes
        text = b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def model(path: str) -> PieceModel:
    """This worker's model for the file; the file lies at the same path on every machine."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Ids of whole texts under a SentencePiece BPE model with byte fallback and no normalisation.

    A text is a leading mark and its characters, spaces as marks; it falls into marked words (marks
    and what follows up to the next mark), which no piece crosses, and words fall where an alphabet
    of the model ends.  Batches are encoded where they lie: their distinct words, as far as the
    worker does not remember them, form a trie.

    Returns ``id_column, n_pieces, ids`` (little-endian unsigned 32-bit numbers), one row per input
    row.  Null and empty texts have no ids.  Other columns are left out, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = (b.slice(i, OUT_ROWS) for b in batches for i in range(0, b.num_rows, OUT_ROWS))
        for batch in small:
            ids = list(model(path).encode(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["_id", "n_pieces", "ids"],
            )

    rows = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).cast("string").alias("_text"))
    return rows.mapInArrow(run, "_id long, n_pieces long, ids binary").withColumnRenamed("_id", id_column)


def decode(encoded: DataFrame, path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """Add the text of ``ids_column`` as ``text``; returns ``id_column, n_pieces, ids, text``.

    Runs of byte pieces are read as UTF-8, with U+FFFD for what is none; null ids give null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1)
            texts = [model(path).decode(x.as_py()) if x.is_valid else None for x in ids]
            sizes = [len(x.as_py()) // 4 if x.is_valid else None for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), ids, pa.array(texts, pa.string())],
                ["_id", "n_pieces", "ids", "text"],
            )

    rows = encoded.select(F.col(id_column).cast("long").alias("_id"), F.col(ids_column).alias("ids"))
    return rows.mapInArrow(run, "_id long, n_pieces long, ids binary, text string").withColumnRenamed(
        "_id", id_column
    )

"""Encoding whole texts with a public tokenizer inside tasks."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer

#: Encoded words that a worker remembers; of more, the half first met stays, which are the most
#: frequent ones.  Forgetting costs time only; a word takes some 160 bytes, as long as the worker lives.
REMEMBERED = 250_000
#: Characters of the longest word that is remembered, so that their number bounds the memory.
LONGEST = 40
#: Characters of text that are divided into words at a time.
AT_ONCE = 200_000

# Fixed value: the pattern that the library's byte-level pre-tokenizer applies.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Before a single space between two characters that are no white space.
_CUT = re.compile(r"(?<=\S)(?= \S)")
#: Printable Latin characters, on whose classes, case and composition all Unicode versions agree.
_LATIN = re.compile("[ -~\n\xa1-\xac\xae-\u012f\u0131-\u017f]*")
_encoders: dict[str, WordwiseEncoder] = {}


def _shown() -> dict[int, str]:
    """The characters that stand for bytes: visible Latin-1 for itself, the rest from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_SHOWN = _shown()


def _latin_pattern(pattern: str) -> re.Pattern | None:
    """The pattern for Latin text in ``re``, which is faster; None if it needs other classes."""
    latin = [chr(i) for i in range(0x180) if _LATIN.fullmatch(chr(i))]
    for name in ("L", "N"):
        members = "".join(f"\\x{ord(x):02x}" if x < "\x80" else x for x in latin if regex.match(rf"\p{{{name}}}", x))
        pattern = re.sub(
            rf"(\[[^\]]*?)?\\p\{{{name}\}}",
            lambda m, members=members: f"{m[1]}{members}" if m[1] else f"[{members}]",
            pattern,
        )
    return None if "\\p" in pattern.lower() else re.compile(pattern)


def _pattern(normalizer: dict | None, divider: dict | None) -> tuple[re.Pattern | None, bool]:
    """How the file's pre-tokenizer divides Latin text, and whether it is lower-cased first.

    None for a file that does anything else than normal forms, white space and case to the text,
    or that divides it by other means than a pattern before the bytes.
    """
    steps = (normalizer or {}).get("normalizers", [normalizer] if normalizer else [])
    kinds = [x["type"] for x in steps]
    spaces = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    if any(x["type"] not in ("NFC", "Lowercase") and x != spaces for x in steps) or divider is None:
        return None, False
    parts = divider.get("pretokenizers", [divider])
    levels = [x for x in parts if x["type"] == "ByteLevel" and not x["add_prefix_space"]]
    if parts == levels and len(levels) == 1 and levels[0]["use_regex"]:
        return _latin_pattern(BYTE_LEVEL), "Lowercase" in kinds
    if len(parts) == 2 and parts[1:] == levels and not levels[0]["use_regex"]:
        cut = parts[0]
        if cut["type"] == "Split" and cut["behavior"] == "Removed" and cut["invert"]:
            return _latin_pattern(cut["pattern"]["Regex"]), "Lowercase" in kinds
    return None, False


def id_type(path: str) -> np.dtype:
    """The narrowest unsigned type that holds the vocabulary's ids."""
    return _narrowest(Tokenizer.from_file(path))


def _narrowest(library: Tokenizer) -> np.dtype:
    size = library.get_vocab_size(with_added_tokens=True)
    return np.dtype("<u2" if size <= 65_536 else "<u4")


class _Known(dict):
    """Ids of words; those of a word that is not at hand are found and kept, long words' apart."""

    def __init__(self, find: Callable[[str], bytes]):
        self.find = find

    def __missing__(self, word: str) -> bytes:
        ids = self.find(word)
        self.keep(word, ids)
        return ids

    def keep(self, word: str, ids: bytes) -> None:
        if len(word) > LONGEST:
            return
        if len(self) >= REMEMBERED:
            kept = list(islice(self.items(), REMEMBERED // 2))
            self.clear()
            self.update(kept)
        self[word] = ids


class WordwiseEncoder:
    """The library's ids for whole texts, each distinct word encoded once.

    Latin text is divided by the pre-tokenizer's pattern, and its words go to the library's merging
    directly, which saves most of the library's time.  Other text is cut before a single space
    between two characters that are not white space.  The pre-tokenizers at hand start a token
    there and hold no state across it, so the parts' ids, one after another, are the text's; each
    part but the first keeps its space.  Special tokens' strings in a text are ordinary text.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.type = _narrowest(self.library)
        self.model = self.library.model
        # only these parts are read, not the vocabulary that fills the file
        parts = [
            x if x is None else json.loads(x.__getstate__())
            for x in (self.library.normalizer, self.library.pre_tokenizer)
        ]
        self.words, self.lower = _pattern(*parts)
        #: By the pre-tokenizer's word for Latin text, by the part between two cuts for other text.
        self.known = _Known(self._merged)
        #: Each id as it is stored.
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.raw = [np.array(i, self.type).tobytes() for i in range(size)]

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.type).tobytes() for x in found]

    def _merged(self, word: str) -> bytes:
        """Ids of one word of the pre-tokenizer's, straight from the library's merging."""
        if word.isascii() and word.isprintable():  # all but the space stand for themselves
            shown = word.replace(" ", _SHOWN[0x20])
        else:
            shown = word.encode("utf-8").decode("latin-1").translate(_SHOWN)
        return b"".join([self.raw[t.id] for t in self.model.tokenize(shown)])

    def _plain(self, text: str) -> bool:
        return self.words is not None and _LATIN.fullmatch(text) is not None

    def _latin(self, text: str) -> bytes:
        words = self.words.findall(text.lower() if self.lower else text)
        return b"".join(map(self.known.__getitem__, words))

    def _other(self, text: str) -> bytes:
        """Ids of a text that is not all Latin; its Latin parts still go the short way."""
        runs = [(plain, list(run)) for plain, run in groupby(_CUT.split(text), self._plain)]
        ids = {x: self.known.get(x) for plain, run in runs if not plain for x in run}
        missing = [x for x, found in ids.items() if found is None]
        for x, found in zip(missing, self._encode(missing), strict=True):
            ids[x] = found
            self.known.keep(x, found)
        return b"".join(
            [self._latin("".join(run)) if plain else b"".join([ids[x] for x in run]) for plain, run in runs]
        )

    def _text(self, text: str) -> bytes:
        found, start = [], 0
        while start < len(text):
            cut = _CUT.search(text, start + AT_ONCE)
            end = cut.start() if cut else len(text)
            part = text[start:end]
            found.append(self._latin(part) if self._plain(part) else self._other(part))
            start = end
        return b"".join(found)

    def encode(self, texts: Iterable[str | None | pa.StringScalar]) -> Iterator[np.ndarray]:
        """Ids of each text in turn; null gives none.  Arrow's texts are read as they are due."""
        for text in texts:
            text = text.as_py() if isinstance(text, pa.Scalar) else text
            yield np.frombuffer(self._text(text or ""), self.type)


def encoder(path: str) -> WordwiseEncoder:
    """This worker's encoder for the file; the file lies at the same path on every machine."""
    if path not in _encoders:
        _encoders[path] = WordwiseEncoder(path)
    return _encoders[path]

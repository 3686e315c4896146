"""Token ids of whole texts by a public tokenizer, with a bounded memory of words.

A tokenizer that drops white space and cuts at it encodes a text as its words
one by one, so words met before need not be encoded again.  Where its file
also says that letters, digits and signs are cut apart and case is folded, a
new word of small letters goes straight to the model, and one with capitals
or with a comma or full stop behind it is put together from that.  Tokenizers
whose file says otherwise get whole texts.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words a worker remembers; later ones are encoded each time they come.
REMEMBERED = 1_000_000
#: Texts are taken together up to so many characters; a longer one is cut at white space.
PART = 1 << 24

_SPACE = re.compile(r"[\x20\x09-\x0d]+")


def folds_words(path: str) -> bool:
    """Whether the file declares what this module relies on."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    normal = [n.get("type") for n in (parts.get("normalizer") or {}).get("normalizers", [])]
    cut = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        normal == ["NFC", "Replace", "Lowercase"]
        and [c.get("type") for c in cut] == ["Split", "ByteLevel"]
        and cut[0].get("behavior") == "Removed"
        and cut[0]["pattern"].get("Regex", "").endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        and not cut[1].get("add_prefix_space")
    )


def _byte_letters() -> dict[int, int]:
    """The letter that byte-level models write for each byte: itself where it is visible."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = sorted(set(range(256)) - set(visible))
    return {b: b for b in visible} | {b: 256 + i for i, b in enumerate(hidden)}


class WordEncoder:
    """Encodes texts to unsigned 32-bit ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = folds_words(path)
        self.known: dict[str, bytes] = {"": b""}
        self.letters = _byte_letters()
        self.signs = {sign: self._whole(sign).tobytes() for sign in ".,"}

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _by_model(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [token.id for token in self.tokenizer.model.tokenize(word)]).tobytes()

    def _new(self, words: list[str], keep: bool) -> dict[str, bytes]:
        """Ids of words that are not remembered."""
        known, signs, found, odd = self.known, self.signs, {}, []
        for word in words:
            sign = word[-1]
            stem = word[:-1] if sign in signs else word
            if stem.isascii():
                stem = stem.lower()
            if stem.isalpha() and stem == stem.lower() and unicodedata.is_normalized("NFC", stem):
                ids = known.get(stem)
                if ids is None:
                    ids = self._by_model(stem)
                    if keep:
                        known[stem] = ids
                found[word] = ids + signs[sign] if sign in signs else ids
            else:
                odd.append(word)
        for at in range(0, len(odd), 1024):
            part = odd[at : at + 1024]
            for word, encoding in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                found[word] = array("I", encoding.ids).tobytes()
        if keep:
            known.update(found)
        return found

    def _of_words(self, words: list[str]) -> list[bytes]:
        ids = list(map(self.known.get, words))
        new = [word for word, known in zip(words, ids, strict=True) if known is None]
        if new:
            found = self._new(new, len(self.known) + 2 * len(new) <= REMEMBERED)
            ids = [found[word] if known is None else known for word, known in zip(words, ids, strict=True)]
        return ids

    def _by_word(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text begins and ends."""
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        ids = self._of_words(coded.dictionary.to_pylist())
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        begins = np.cumsum(lengths) - lengths
        vocabulary = np.frombuffer(b"".join(ids), "<u4")
        places = coded.indices.to_numpy()
        counts = lengths[places]
        after = np.cumsum(counts)
        total = int(after[-1]) if len(after) else 0
        at = np.repeat(begins[places] - (after - counts), counts)
        at += np.arange(total)
        ends = np.concatenate([[0], after])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        return vocabulary[at], ends

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text in turn; null is empty."""
        held, size = [], 0
        for text in texts:
            text = text or ""
            if size and size + len(text) > PART:
                yield from self._flush(held)
                held, size = [], 0
            if len(text) > PART and self.by_word:
                yield np.concatenate([ids for part in _parts(text) for ids in self._flush([part])])
                continue
            held.append(text)
            size += len(text)
        yield from self._flush(held)

    def _flush(self, texts: list[str]) -> Iterator[np.ndarray]:
        if not self.by_word:
            yield from map(self._whole, texts)
        elif texts:
            ids, ends = self._by_word(texts)
            for begin, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                yield ids[begin:end]


def _parts(text: str) -> Iterator[str]:
    """A long text cut at white space."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + PART)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


@cache
def encoder(path: str) -> WordEncoder:
    """The worker's encoder; it lives as long as the worker."""
    return WordEncoder(path)

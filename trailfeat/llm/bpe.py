"""Token ids of whole texts for tokenizer files of the ``tokenizers`` library.

Two forms of file are known by their serialised parts: byte-level BPE over the
usual pre-token pattern, and lower-cased BPE with word ends. For these the merges
are applied by the ``tiktoken`` engine, with the ranks taken from the file itself,
which is several times faster than the library and needs no cache of words. Word
ends are written as a byte that no text holds. A file is only taken this way if
its merges are in the order of their ids and every entry of its vocabulary comes
out of the merges (checked when it is loaded); texts that hold a special token, words with
characters that normalisation could change, and all other files go through the
library. The result is the same as
``Tokenizer.encode(text, add_special_tokens=False).ids``.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

#: Words with unusual characters whose ids a worker keeps; beyond it the cache starts anew.
CACHE_WORDS = 100_000
#: Code points that are encoded at once: longer texts are cut where no pre-token crosses.
PIECE_CHARS = 1 << 20

_ENCODERS: dict[str, Encoder] = {}
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "fuse_unk": False,
          "byte_fallback": False, "ignore_merges": False}
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
#: The parts of a file that are known, by form.
_FORMS = {
    "bytes": {"normalizer": None, "pre_tokenizer": {**_BYTE_LEVEL, "use_regex": True},
              "model": {**_MODEL, "end_of_word_suffix": None}},
    "words": {"normalizer": {"type": "Sequence", "normalizers": [
                  {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
              "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
                  {"type": "Split", "pattern": {"Regex": _WORDS}, "behavior": "Removed", "invert": True},
                  {**_BYTE_LEVEL, "use_regex": False}]},
              "model": {**_MODEL, "end_of_word_suffix": "</w>"}},
}
_END = "\0"
# characters that normalisation leaves alone or lower-cases one by one (Latin-1 without its digits)
_PLAIN = "!-~¡-±´-¸º»¿-ÿ"
_PLAIN_WORD = re.compile(f"[{_PLAIN}]+")
_PLAIN_TEXT = re.compile(f"[{_PLAIN} \n]*")
_RUNS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\w\s]|_)+")
# a space that begins a new pre-token in both forms
_CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")


def _byte_letters() -> dict[str, int]:
    """The byte behind each printable letter of a byte-level vocabulary."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {(chr(b) if b in shown else chr(next(rest))): b for b in range(256)}


def form_of(file: dict) -> str | None:
    """Which of the known forms a tokenizer file has."""
    for form, parts in _FORMS.items():
        model = {k: v for k, v in file["model"].items() if k not in ("vocab", "merges")}
        if (file.get("normalizer"), file.get("pre_tokenizer"), model) == (
                parts["normalizer"], parts["pre_tokenizer"], parts["model"]) and not file.get("truncation") and not file.get("padding"):
            return form
    return None


class Encoder:
    """``encode(text)`` gives the ids as bytes, four per id (little-endian)."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.cache_words, self.words = cache_words, {}
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.special = [t["content"] for t in file.get("added_tokens") or []]
        self.form = form_of(file)
        self.engine = self._engine(file) if self.form else None

    def _engine(self, file: dict):
        """The merges of the file in ``tiktoken``, or None where they would not give the library's ids."""
        import tiktoken

        vocabulary = {w: i for w, i in file["model"]["vocab"].items() if w not in self.special}
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in file["model"]["merges"]]
        ids = [vocabulary.get(w, -1) for w in merged]
        firsts = len(vocabulary) - len(set(merged))
        letters, end = _byte_letters(), "</w>" if self.form == "words" else ""
        if any(a >= b for a, b in zip(ids, ids[1:], strict=False)) or (ids and ids[0] < firsts) or firsts != 256 * (1 + bool(end)):
            return None
        ranks = {}
        for word, i in vocabulary.items():
            ends = bool(end) and word.endswith(end)
            plain = word[:-len(end)] if ends else word
            ranks[bytes(letters[c] for c in plain) + (_END.encode() if ends else b"")] = i
            # the engine takes a whole word from the vocabulary, the library only what its merges reach
            if ends or not end:
                if [t.id for t in self.tok.model.tokenize(plain)] != [i]:
                    return None
        return tiktoken.Encoding("file", pat_str=f"[^{_END}]+{_END}" if end else _PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _library(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _ids(self, text: str) -> bytes:
        return np.asarray(self.engine.encode_ordinary(text), dtype="<u4").tobytes()

    def _runs(self, text: str) -> bytes:
        """Ids of plain text in the form of words."""
        runs = _RUNS.findall(text.lower())
        return self._ids(_END.join(runs) + _END) if runs else b""

    def _odd_word(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            if len(self.words) >= self.cache_words:
                self.words.clear()
            got = self.words[word] = self._library(word)
        return got

    def _piece(self, text: str) -> bytes:
        if self.form == "bytes":
            return self._ids(text)
        if _PLAIN_TEXT.fullmatch(text):
            return self._runs(text)
        out, held = [], []
        for word in text.replace("\n", " ").split(" "):
            if _PLAIN_WORD.fullmatch(word):
                held.append(word)
            elif word:
                out += [self._runs(" ".join(held)), self._odd_word(word)]
                held = []
        return b"".join(out) + self._runs(" ".join(held))

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.engine is None or any(s in text for s in self.special):
            return self._library(text)
        out, at = [], 0
        while len(text) - at > PIECE_CHARS:
            cut = _CUT.search(text, at + PIECE_CHARS)
            if not cut:
                break
            out.append(self._piece(text[at:cut.start()]))
            at = cut.start()
        return b"".join(out) + self._piece(text[at:] if at else text)


def encoder(path: str, cache_words: int = CACHE_WORDS) -> Encoder:
    """The worker's encoder for a tokenizer file (loaded once)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, cache_words)
    return _ENCODERS[path]


def vocabulary_size(path: str) -> int:
    """Ids of a tokenizer file, special tokens included."""
    return encoder(path).tok.get_vocab_size()


def release() -> None:
    """Drop the worker's encoders and their caches, where later stages need the memory."""
    _ENCODERS.clear()

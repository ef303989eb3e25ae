"""Token ids of whole texts with a given tokenizer file, one library call per new word.

Both tokenizers used here cut a text before a space or line end that follows another
character, whatever comes later, so ids of a text are the ids of its pieces in order.
Pieces repeat; their ids are kept in a table of bounded size. Both also cut between Latin
letters and the signs behind them, so the ids of a new piece are put together from those
of its word, in lower case where the tokenizer lowers it, and of its signs, which repeat
more often. Texts with other white space go to the library whole.
"""

from __future__ import annotations

import os
import re
from itertools import islice

import numpy as np

CACHE_WORDS, CACHE_PARTS = 800_000, 700_000
GROUP = 64

# A run of spaces and line ends with the word after it, a word with one space before
# it, or a single separator.
_PIECE = re.compile(r"[ \n]{2,}[^ \n]*| ?[^ \n]+|[ \n]")
_OTHER_SPACE = re.compile(r"[^\S \n]|[\x1c-\x1f\x01]")
_ASCII_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x01"  # those of them in ASCII
# Latin-1 letters after at most a space, then ASCII signs; an apostrophe can belong to both sides.
_WORD = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_CAPITALS = " ".join("ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ")


def _has_other_space(text: str) -> bool:
    if text.isascii():
        return any(c in text for c in _ASCII_SPACE)
    return _OTHER_SPACE.search(text) is not None


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, drops_space: bool = False) -> Encoder:
    """The encoder of this worker process: what it has learnt serves all its tasks."""
    if (path, drops_space) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, drops_space] = Encoder(path, drops_space)
    return _ENCODERS[path, drops_space]


class Encoder:
    """``encode(texts)`` gives the ids of each text, as the library gives them.

    ``drops_space`` tells that the tokenizer ignores white space altogether.
    """

    def __init__(self, path: str, drops_space: bool = False, most: int = CACHE_WORDS,
                 most_parts: int = CACHE_PARTS):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        self.tokenizer = Tokenizer.from_file(path)
        self.drops_space = drops_space
        self.separator = " \x01 " if drops_space else "\n"
        self.mark = self._ids(["\x01" if drops_space else "\n"])[0]
        self.lowers = self._ids([_CAPITALS]) == self._ids([_CAPITALS.lower()])
        self.most, self.known = most, ({}, {})  # of plain pieces, of words after a space
        self.most_parts, self.parts = most_parts, {"": b""}  # of words and signs in pieces

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _put_together(self, new: list[str]) -> dict[str, bytes]:
        """The ids of new pieces from those of their parts."""
        whole, words = [], []
        for piece in new:
            match = _WORD.fullmatch(piece)
            if match is None:
                whole.append(piece)
            else:
                words.append((piece, match[1].lower() if self.lowers else match[1], match[2]))
        parts = {word for _, word, _ in words}
        parts.update(signs for _, _, signs in words)
        more = self._learn(list(parts.difference(self.parts)))
        known = self.parts
        out = {piece: (known[word] if word in known else more[word]) + (known[signs] if signs in known else more[signs])
               for piece, word, signs in words}
        self.parts.update(islice(more.items(), max(0, self.most_parts - len(self.parts))))
        out.update(self._learn(whole))
        return out

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """The ids of new pieces; words go to the library in groups between separators."""
        plain = [p for p in new if "\n" not in p and not p.isspace() and p[:2] != "  "]
        odd = [p for p in new if "\n" in p or p.isspace() or p[:2] == "  "]
        out = {p: np.array(ids, np.uint32).tobytes() for p, ids in zip(odd, self._ids(odd), strict=True)}
        groups = [plain[k:k + GROUP] for k in range(0, len(plain), GROUP)]
        for group, ids in zip(groups, self._ids([self.separator.join(g) for g in groups]), strict=True):
            ids = np.array(ids, np.uint32)
            cuts = np.flatnonzero(ids == self.mark[0])
            if len(self.mark) == 1 and len(cuts) == len(group) - 1:
                starts, ends = [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]
                for piece, a, b in zip(group, starts, ends, strict=True):
                    out[piece] = ids[a:b].tobytes()
            else:
                out.update((p, np.array(i, np.uint32).tobytes()) for p, i in zip(group, self._ids(group), strict=True))
        return out

    def _split(self, text: str) -> list[tuple[bool, list[str]]]:
        """The pieces of a text in order, as runs of plain pieces and of words after one space each."""
        if self.drops_space:
            return [(False, text.split())]
        if not text or text[0] in " \n" or text[-1] in " \n" or any(run in text for run in ("  ", " \n", "\n ", "\n\n")):
            return [(False, _PIECE.findall(text))]
        runs = []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            runs += [(False, ["\n", first] if runs else [first]), (True, rest)]
        return runs

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text as 32-bit numbers; NULL counts as empty."""
        texts = [text or "" for text in texts]
        whole = [k for k, text in enumerate(texts) if _has_other_space(text)]
        parts = [[] for _ in texts]
        new: tuple[set[str], set[str]] = set(), set()
        gets = [known.get for known in self.known]
        for k in sorted(set(range(len(texts))).difference(whole)):
            for spaced, keys in self._split(texts[k]):
                found = list(map(gets[spaced], keys))
                gaps = [i for i, ids in enumerate(found) if ids is None]
                new[spaced].update([keys[i] for i in gaps])
                parts[k].append((spaced, found, gaps, [keys[i] for i in gaps]))
        learnt = [self._put_together(list(new[0])), {p[1:]: ids for p, ids in self._put_together([" " + p for p in new[1]]).items()}]
        out = []
        for part in parts:
            for spaced, found, gaps, keys in part:
                for i, key in zip(gaps, keys, strict=True):
                    found[i] = learnt[spaced][key]
            out.append(np.frombuffer(b"".join([b"".join(found) for _, found, _, _ in part]), np.uint32))
        for known, more in zip(self.known, learnt, strict=True):
            known.update(islice(more.items(), max(0, self.most - sum(map(len, self.known)))))
        for k, ids in zip(whole, self._ids([texts[k] for k in whole]), strict=True):
            out[k] = np.array(ids, np.uint32)
        return out

"""Token ids of whole texts by a public tokenizer file, with a bounded memo.

The tokenizer lower-cases, drops white space and never merges across it; it
parts letters, single digits and runs of other marks.  So the ids of a text are
those of its space- and newline-separated pieces in order, in a line of plain
words those of "Word," are the ids of "word" and of ",", and a line of ASCII
and Latin letters without apostrophes may be parted as the tokenizer does.
The tokenizers library encodes every distinct piece once while it is
remembered; the memo keeps its answers, one number for each piece into one
array of ids, and is emptied when it holds ``MEMO_PIECES`` of them.
"""

from __future__ import annotations

import os
import re
import sys
from itertools import chain

import numpy as np

END_ID = 1
TOKENIZER = "word_bpe_49k.json"
MEMO_PIECES = 600_000
# Words of Latin letters, which lower-case one by one, each with one mark at most.
PLAIN_LINE = re.compile("(?:[A-Za-zÀ-ÖØ-öø-ÿ]++[.,]?+(?: ++|\\Z))*+")
PLAIN_WORD = re.compile("[a-zß-öø-ÿ]++")
# Lines that can be parted here; "'" starts pieces of its own, "<" may start a special token.
LATIN_LINE = re.compile("[ !-&(-;=-~À-ÖØ-öø-ÿ]*+")
PARTS = re.compile("[a-zß-öø-ÿ]+|[0-9]|[^ a-zß-öø-ÿ0-9]+")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def worker_encoder(path: str | None = None) -> Encoder:
    """The encoder of this Python worker: later tasks find it, with its memo."""
    held = sys.__dict__.setdefault("_mercato_encoders", {})
    path = path or tokenizer_path()
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


class Pieces(dict):
    """A number for each piece, given when it is first looked up."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str | None = None, end_id: int = END_ID):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path or tokenizer_path())
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.end = np.array([end_id], "<u4").tobytes()
        self.forget()

    def forget(self) -> None:
        self.memo, self.ids = Pieces(), np.empty(0, "<u4")
        self.starts, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64)

    def each(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of plain words, encoded as one text and parted at the tokens
        that end a word."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = ((np.flatnonzero(self.ends_word[ids]) + 1) * 4).tolist()
        if len(ends) != len(words):  # another kind of tokenizer file
            return self.each(words)
        packed = ids.tobytes()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def learn(self) -> None:
        """Encodes the pieces that were looked up for the first time."""
        new, self.memo.new = self.memo.new, []
        if not new:
            return
        found: list[bytes] = [b""] * len(new)
        plain = [i for i, p in enumerate(new) if PLAIN_WORD.fullmatch(p)]
        for k in range(0, len(plain), 10_000):
            some = plain[k:k + 10_000]
            for i, ids in zip(some, self.encode_words([new[i] for i in some])):
                found[i] = ids
        odd = sorted(set(range(len(new))).difference(plain))
        for i, ids in zip(odd, self.each([new[i] for i in odd])):
            found[i] = ids
        sizes = np.array([len(x) // 4 for x in found], np.int64)
        self.starts = np.r_[self.starts, len(self.ids) + np.cumsum(sizes) - sizes]
        self.sizes = np.r_[self.sizes, sizes]
        self.ids = np.r_[self.ids, np.frombuffer(b"".join(found), "<u4")]

    @staticmethod
    def parted(text: str) -> list[str]:
        pieces: list[str] = []
        for line in text.split("\n"):
            if PLAIN_LINE.fullmatch(line):
                pieces += line.lower().replace(".", " .").replace(",", " ,").split(" ")
            elif LATIN_LINE.fullmatch(line):
                pieces += PARTS.findall(line.lower())
            else:
                pieces += line.split(" ")
        return pieces

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, the end id appended."""
        parts = [self.parted(text) for text in texts]
        many = np.array([len(p) for p in parts], np.int64)
        at = np.fromiter(map(self.memo.__getitem__, chain.from_iterable(parts)), np.int64, int(many.sum()))
        del parts
        self.learn()
        sizes = self.sizes[at]
        ends = np.r_[0, np.cumsum(sizes)]
        flat = self.ids[np.repeat(self.starts[at] - ends[:-1], sizes) + np.arange(ends[-1])].tobytes()
        edges = (4 * ends[np.r_[0, np.cumsum(many)]]).tolist()
        if len(self.memo) > MEMO_PIECES:
            self.forget()
        return [flat[a:b] + self.end for a, b in zip(edges, edges[1:])]

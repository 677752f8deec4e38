"""Encoding of whole texts with a public tokenizer, chunk by chunk through a bounded memo.

A pre-tokeniser never lets a token run from a character into white space that follows it, nor
from a letter into one of the marks in ``MARKS``. Texts are cut at such places only, so the
ids of a text are the ids of its chunks in a row, and each frequent chunk is encoded once.
A text that holds the string of an added token, such as ``<|endoftext|>``, is encoded whole,
so that the library finds that token as it does in any text.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np

from roostline.llm.common import Memo, worker_cache

SPACE = rb"\x20\x09-\x0D"
MARKS = rb".,!?;:*$%&#|"
# Possessive: giving characters back could never lead to a match.
CHUNK = re.compile(
    rb"[%s]*+[A-Za-z]++(?=[%s])|[%s]*+[^%s]++|[%s]++" % (SPACE, re.escape(MARKS), SPACE, SPACE, SPACE)
)
# White space beyond ASCII: chunk borders are not certain there.
WIDE_SPACE = re.compile("[\x85\xa0  -     　]")
CHUNKS_KEPT = 600_000


class Encoder:
    """Ids of texts as bytes of little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, lower: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = sorted({a.lower() if lower else a for a in added})
        self.lower = lower
        self.memo = Memo(self._encode_chunks, CHUNKS_KEPT)
        # Between two chunks of a joined text stands a text of one known id, which no
        # joined chunk can hold.
        self.between = " | " if lower else "\n"
        self.mark = self._ids([self.between.strip(" ")])[0]
        self.joinable = (
            re.compile(rb"[%s]*[^%s|]+" % (SPACE, SPACE)) if lower else re.compile(rb" ?[^%s]+" % SPACE)
        )
        # Byte-level tokens show a space as this letter: chunks that begin with their only space
        # can be joined with nothing between them, and begin at such tokens again.
        vocab = {} if lower else self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocab.values(), default=-1) + 1, bool)
        self.spaced[[i for token, i in vocab.items() if token.startswith("\u0120")]] = True

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _cut(self, ids: np.ndarray, starts: list[int], stops: list[int]) -> list[bytes]:
        raw = ids.tobytes()
        return list(map(raw.__getitem__, map(slice, starts, stops)))

    def _encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        found: dict[bytes, bytes] = {}
        easy = [c for c in chunks if self.joinable.fullmatch(c)]
        spaced = [c for c in easy if c.startswith(b" ")] if self.spaced.any() else []
        for at in range(0, len(spaced), 512):
            part = spaced[at : at + 512]
            ids = np.array(self._ids([b"".join(part).decode("utf-8", "surrogatepass")])[0], "<u4")
            starts = (4 * np.flatnonzero(self.spaced[ids])).tolist()
            if len(starts) == len(part):
                found.update(zip(part, self._cut(ids, starts, [*starts[1:], 4 * len(ids)])))
        easy = [c for c in easy if c not in found] if found else easy
        for at in range(0, len(easy), 512):
            part = easy[at : at + 512]
            joined = self.between.encode().join(part).decode("utf-8", "surrogatepass")
            ids = np.array(self._ids([joined])[0], "<u4")
            cuts = np.flatnonzero(ids == self.mark[0])
            if len(self.mark) == 1 and len(cuts) == len(part) - 1:
                starts = [0, *(4 * cuts + 4).tolist()]
                stops = [*(4 * cuts).tolist(), 4 * len(ids)]
                found.update(zip(part, self._cut(ids, starts, stops)))
        rest = [c for c in chunks if c not in found]
        if rest:
            single = self._ids([c.decode("utf-8", "surrogatepass") for c in rest])
            found.update((c, np.array(ids, "<u4").tobytes()) for c, ids in zip(rest, single))
        return list(map(found.__getitem__, chunks))

    def encode(self, texts: list[str]) -> list[bytes]:
        chunked = []
        for text in texts:
            raw = text.encode("utf-8", "surrogatepass")
            raw = raw.lower() if self.lower else raw
            wide = not self.lower and not text.isascii() and WIDE_SPACE.search(text)
            whole = wide or any(a in raw for a in self.added)
            chunked.append(None if whole else CHUNK.findall(raw))
        # A part of the texts at a time, so that the memo never has to hold all chunks.
        result: list[bytes] = []
        group: list[int] = []
        size = 0
        for n, chunks in enumerate(chunked):
            group.append(n)
            size += len(chunks or ())
            if size >= 1_000_000 or n == len(chunked) - 1:
                known = self.memo.load(chain.from_iterable(chunked[g] or () for g in group))
                for g in group:
                    if chunked[g] is None:
                        result.append(np.array(self._ids([texts[g]])[0], "<u4").tobytes())
                    else:
                        result.append(b"".join(map(known.__getitem__, chunked[g])))
                        chunked[g] = ()
                group, size = [], 0
        return result


def encoder(path: str, lower: bool = False) -> Encoder:
    """The worker's encoder of a vocabulary file, kept between tasks."""
    kept = worker_cache("tokens")
    if (path, lower) not in kept:
        kept.clear()
        kept[path, lower] = Encoder(path, lower)
    return kept[path, lower]

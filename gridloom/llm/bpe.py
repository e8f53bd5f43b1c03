"""Exact byte-level BPE ids of whole texts, with a cache of the words between single spaces and line feeds."""

from __future__ import annotations

import os
from array import array
from functools import lru_cache
from itertools import islice

END_ID = 2
#: Runs of these after letters are a pre-token of their own.
MARKS = ".,;:!?%&$*#|"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class PieceEncoder:
    """encode(text): the little-endian unsigned 32-bit ids of the whole text.

    The pre-tokenizer's pattern lets a space only begin a word, so a single space between two characters that are no
    white space begins a pre-token, and a single line feed between two such characters is one. The ids of a text are
    therefore those of its pieces in a row. Each distinct piece goes through the tokenizers library once while it
    stays in the cache; letters followed by marks are put together from both. Texts with adjacent white space are
    encoded as they are. The cache holds at most max_entries pieces; beyond, the half that came first stays, which
    has the frequent ones.
    """

    def __init__(self, path: str, max_entries: int = 600_000, max_piece: int = 200):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        (self.line_feed,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.max_entries, self.max_piece = max_entries, max_piece
        self.first: dict[str, bytes] = {}
        self.rest: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, cache: dict[str, bytes], pieces: list[str], lead: str) -> None:
        """Encode pieces as the lines of a few larger texts, cut at the ids of the line feeds."""
        groups = [pieces[i : i + 400] for i in range(0, len(pieces), 400)]
        joined = ["\n".join([lead + p for p in g]) for g in groups]
        for g, e in zip(groups, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
            ids = array("I", e.ids)
            data, at = ids.tobytes(), 0
            for p, end in zip(g, [*(i for i, x in enumerate(ids) if x == self.line_feed), len(ids)], strict=True):
                cache[p] = data[4 * at : 4 * end]
                at = end + 1

    def _add(self, cache: dict[str, bytes], pieces: set[str], lead: str) -> None:
        marked, plain = [], set()
        for p in pieces:
            if p.isalpha():
                plain.add(p)
                continue
            core = p.rstrip(MARKS)
            if core and len(core) < len(p) and core.isalpha():
                marked.append((p, core, p[len(core) :]))
                if core not in cache:
                    plain.add(core)
            else:
                plain.add(p)
        self._learn(cache, list(plain), lead)
        marks = {m for _, _, m in marked if m not in self.first}
        if marks:
            self._learn(self.first, list(marks), "")
        for p, core, m in marked:
            cache[p] = cache[core] + self.first[m]

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        if len(self.rest) + len(self.first) > self.max_entries:
            self.rest = dict(islice(self.rest.items(), self.max_entries // 2))
            self.first = dict(islice(self.first.items(), self.max_entries // 8))
        cut = [[line.split(" ") for line in t.split("\n")] if t else None for t in texts]
        heads, words = set(), set()
        for lines in cut:
            for p in lines or ():
                heads.add(p[0])
                words.update(islice(p, 1, None))
        heads = {p for p in heads if p not in self.first}
        words = {p for p in words if p not in self.rest}  # -= would walk the whole cache
        odd = {p for p in heads | words if not p or p[0].isspace() or p[-1].isspace() or len(p) > self.max_piece}
        self._add(self.first, heads - odd, "")
        self._add(self.rest, words - odd, " ")
        first, rest, feed, out = self.first, self.rest.__getitem__, array("I", [self.line_feed]).tobytes(), []
        for text, lines in zip(texts, cut):
            if lines is None:
                out.append(b"")
            elif odd and any(not odd.isdisjoint(p) for p in lines):
                out += self._whole([text])
            else:
                parts = []
                for p in lines:
                    parts.append(feed)
                    parts.append(first[p[0]])
                    parts.extend(map(rest, islice(p, 1, None)))
                out.append(b"".join(parts[1:]))
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_many([text])[0]


@lru_cache(2)
def encoder(path: str, max_entries: int = 600_000) -> PieceEncoder:
    """One for each Python worker and path: the cache stays warm from task to task, at about 0.5 kB of memory an entry."""
    return PieceEncoder(path, max_entries)

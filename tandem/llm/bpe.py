"""Byte-level BPE of whole texts, cut only where a boundary is proven.

The vocabulary is a tokenizer file (.json). Its merges are run by the rank encoder, which
gives the same ids several times faster; a file whose ids do not follow its merges, or whose
pre-tokenizer is another one, is refused.

A place between a word character and what cannot go on with it is a boundary whatever
stands before or after: no token of the pattern goes across, nothing left of it looks past
it, and matching starts anew at it. Inside the special string no such place is counted.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import tiktoken

#: Characters of a chunk of a long text.
CHUNK = 1 << 16
#: Characters on either side of a cut that both neighbours read.
OVERLAP = 256

# The split pattern of byte-level pre-tokenizers.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Proven boundaries: before white space, between letters and digits, before punctuation
# (the bar is left out, since it follows a letter in the special string).
STABLE = re.compile(
    r"(?<=\S)(?=[ \n\r\t])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"
    r"|(?<=[^\W_])(?=[,.;:!?()/+=、。，．！？：；])"
)


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies use for bytes: printable ones stand for
    themselves, the others are numbered from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before = spec["pre_tokenizer"] or {}
        if (
            spec["model"]["type"] != "BPE" or spec["normalizer"] or before.get("type") != "ByteLevel"
            or before.get("add_prefix_space") or not before.get("use_regex", True)
        ):
            raise ValueError(f"{path} is not a plain byte-level BPE")
        letter = _byte_letters()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {
            bytes(letter[c] for c in token): i
            for token, i in spec["model"]["vocab"].items() if token not in special
        }
        last = -1
        for merge in spec["model"]["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            rank = ranks[bytes(letter[c] for c in a + b)]
            if rank <= last:
                raise ValueError(f"the ids of {path} do not follow its merges")
            last = rank
        self.special = set(special)
        self._bpe = tiktoken.Encoding(
            "byte_level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
        size = max([*ranks.values(), *special.values()]) + 1
        self.token_bytes = np.zeros(size, dtype=np.int64)
        for token, i in [*ranks.items(), *((s.encode(), i) for s, i in special.items())]:
            self.token_bytes[i] = len(token)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text that is not cut; special strings become their ids."""
        ids = self._bpe.encode(text, allowed_special=self.special, disallowed_special=())
        return np.array(ids, dtype=np.uint32)

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text of any length."""
        cuts = [c for c, _ in boundaries(text)]
        if not cuts:
            return self.encode(text)
        parts = zip([0, *cuts], [*cuts, len(text)])
        return np.concatenate([self.encode(text[a:b]) for a, b in parts])

    def count_between(self, text: str, low: int, high: int) -> int:
        """Tokens of ``text`` between two byte offsets, both of which must be boundaries."""
        ends = np.concatenate([[0], np.cumsum(self.token_bytes[self.encode(text)])])
        at = np.searchsorted(ends, [low, high])
        if ends[at[0]] != low or ends[at[1]] != high:
            raise ValueError("the encodings of two chunks do not share a boundary")
        return int(at[1] - at[0])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def boundaries(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """Cuts of a long text: (place, characters of overlap on either side).

    Near each multiple of ``chunk`` the first proven boundary of the overlap is taken. An
    overlap without one is widened, to the ends of the text if it must be; then there is
    no cut.
    """
    out: list[tuple[int, int]] = []
    for middle in range(chunk, len(text), chunk):
        wide = overlap
        while True:
            low, high = max(0, middle - wide), min(len(text), middle + wide)
            found = STABLE.search(text, low + 1, high)
            if found or (low == 0 and high == len(text)):
                break
            wide *= 2
        if found and (not out or found.start() > out[-1][0]):
            out.append((found.start(), wide))
    return out


def chunks(
    text: str, chunk: int = CHUNK, overlap: int = OVERLAP
) -> list[tuple[str, int, int]]:
    """A text as overlapping chunks: (chunk, first byte that is its own, byte after)."""
    cuts = boundaries(text, chunk, overlap)
    edges = [(0, 0), *cuts, (len(text), 0)]
    out = []
    for (a, left), (b, right) in zip(edges, edges[1:]):
        # The overlap itself begins and ends at proven boundaries, or at the text's ends.
        low = _stable_from(text, max(0, a - left), a)
        high = _stable_from(text, min(len(text), b + right), len(text))
        before = len(text[low:a].encode("utf-8", "replace"))
        own = len(text[a:b].encode("utf-8", "replace"))
        out.append((text[low:high], before, before + own))
    return out


def _stable_from(text: str, at: int, end: int) -> int:
    if at == 0 or at >= end:
        return at
    found = STABLE.search(text, at, end)
    return found.start() if found else end

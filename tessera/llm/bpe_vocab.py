"""Byte-level BPE vocabulary read from a ``tokenizers`` JSON file."""

from __future__ import annotations

import hashlib
import json
from heapq import heapify, heappop, heappush

import regex

# The split pattern of the byte-level pre-tokenizer.
PRETOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
            r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in the file:
    printable Latin-1 bytes stand for themselves, the others are numbered
    from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Merge table over token ids; built once per Python worker.

    ``merge`` maps ``left_id << 32 | right_id`` to ``(rank, merged_id)``.
    """

    def __init__(self, blob: bytes):
        spec = json.loads(blob)
        model = spec["model"]
        pre = spec.get("pre_tokenizer") or {}
        if (model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or spec.get("normalizer")
                or pre.get("add_prefix_space") or not pre.get("use_regex", True)
                or model.get("ignore_merges") or model.get("byte_fallback")):
            raise ValueError("not a plain byte-level BPE file")
        ids = model["vocab"]
        chars = byte_characters()
        to_byte = {c: b for b, c in enumerate(chars)}
        self.byte_ids = [ids[c] for c in chars]
        self.merge: dict[int, tuple[int, int]] = {}
        self.rules: list[tuple[int, int, int]] = []       # (left, right, merged) by rank
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, c = ids[left], ids[right], ids[left + right]
            self.merge[a << 32 | b] = (rank, c)
            self.rules.append((a, b, c))
        self.rank_of = {k: rank for k, (rank, _) in self.merge.items()}.get
        self.bytes_of = {i: bytes(to_byte[c] for c in t) for t, i in ids.items()
                         if all(c in to_byte for c in t)}
        self.special: dict[str, int] = {}
        for t in spec.get("added_tokens") or []:
            if t.get("single_word") or t.get("lstrip") or t.get("rstrip"):
                raise ValueError(f"added token with options: {t['content']}")
            self.special[t["content"]] = t["id"]
            self.bytes_of[t["id"]] = t["content"].encode()
        self.find = regex.compile(PRETOKEN)
        longest_first = sorted(self.special, key=len, reverse=True)
        #: a space that white space or the end follows: see ``words``
        self.loose_space = regex.compile(r" (?:\p{White_Space}|\Z)")
        self.find_special = (regex.compile("|".join(map(regex.escape, longest_first)))
                             if longest_first else None)

    def segments(self, text: str):
        """The text cut at added tokens: (plain piece, id of the added token
        after it or None)."""
        at = 0
        if self.find_special:
            for m in self.find_special.finditer(text):
                yield text[at:m.start()], self.special[m.group()]
                at = m.end()
        yield text[at:] if at else text, None

    def words(self, text: str) -> list[str] | None:
        """The text cut before each space, the spaces taken off; None where a
        space is followed by white space or the end.  Every space then starts
        a pre-token, so the pieces are split into pre-tokens independently."""
        return None if self.loose_space.search(text) else text.split(" ")

    def merge_symbols(self, symbols: list[int]) -> tuple[list[int], int]:
        """Byte-pair merging with a heap over a linked list of symbols.

        Pops the lowest-rank adjacent pair (leftmost first) until no pair has
        a rule; an entry whose pair has changed since it was pushed is stale
        and skipped.  Returns (symbol slots, merges); merged-away slots hold
        -1.  ``symbols`` is changed in place.
        """
        n, merge = len(symbols), self.merge
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = merge.get(symbols[i] << 32 | symbols[i + 1])
            if found:
                heap.append((found[0], i))
        heapify(heap)
        merges = 0
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if symbols[i] < 0 or j >= n:
                continue
            found = merge.get(symbols[i] << 32 | symbols[j])
            if not found or found[0] != rank:
                continue
            symbols[i], symbols[j] = found[1], -1
            merges += 1
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                right = merge.get(found[1] << 32 | symbols[j])
                if right:
                    heappush(heap, (right[0], i))
            h = before[i]
            if h >= 0:
                left = merge.get(symbols[h] << 32 | found[1])
                if left:
                    heappush(heap, (left[0], h))
        return symbols, merges


_LOADED: dict[str, Vocabulary] = {}


def load(blob: bytes) -> Vocabulary:
    """The vocabulary of a file's bytes, parsed once per process."""
    key = hashlib.sha256(blob).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Vocabulary(blob)
    return _LOADED[key]

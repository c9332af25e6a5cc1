"""Byte-level BPE with the tokenizers library, through a cache of the runs between white space."""

from __future__ import annotations

import base64
import gc
import json
import re

import numpy as np
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

#: White space of the split pattern. A run of it after another character always starts a new match of the pattern.
SPACE = "\t-\r " + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
SPACES = frozenset(re.findall(f"[{SPACE}]", "".join(map(chr, range(0x3001)))))
#: Marks of which any run behind a letter is a match of the pattern by itself.
MARKS = ".,;:!?#&$%*|"


def byte_characters() -> dict[int, str]:
    """The byte table of byte-level vocabularies: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """Every way to split a token into two tokens, in the order of ranks: the pairs that a rank file lets merge."""
    out = []
    for token, _ in sorted(ranks.items(), key=lambda x: x[1]):
        if len(token) > 1:
            out += [(token[:k], token[k:]) for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks]
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class ChunkEncoder:
    """Token ids of texts as the bytes of unsigned little-endian 32-bit numbers.

    Each match of the split pattern is encoded by itself, and matches never reach over the start of a chunk (see SPACE), so a
    text's ids are its chunks' ids in turn. New chunks are encoded together, joined to one text, and cut by the byte lengths of
    the tokens; marks behind a letter are a match by themselves, so such chunks are put together from stem and marks. The cache has
    two generations of about `cache` / 2 chunks: when the younger is full the older is forgotten, and what is met again comes
    over. Chunks over `longest` characters are not kept.
    """

    def __init__(self, tokenizer: Tokenizer, special: dict[str, int] | None = None, cache: int = 1_000_000, longest: int = 48):
        self.tokenizer, self.special, self.size, self.longest = tokenizer, special or {}, cache, longest
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        back = {c: b for b, c in byte_characters().items()}
        vocabulary = tokenizer.get_vocab() | self.special
        self.pieces = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.pieces[i] = token.encode() if token in self.special else bytes(back[c] for c in token)
        self.widths = np.fromiter(map(len, self.pieces), np.int64, len(self.pieces))
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def from_json(cls, path: str, **options) -> ChunkEncoder:
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        split = kind.get("pre_tokenizer") or {}
        if kind.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            raise ValueError(f"{path} is not a plain byte-level vocabulary")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in kind["model"]["merges"]]
        # the library's own cache of words is off, since it sees every chunk once
        tokenizer = Tokenizer(models.BPE(vocab=kind["model"]["vocab"], merges=merges, cache_capacity=0, ignore_merges=kind["model"].get("ignore_merges", False)))
        tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        return cls(tokenizer, {t["content"]: t["id"] for t in kind.get("added_tokens", [])}, **options)

    @classmethod
    def from_ranks(cls, path: str, pattern: str, **options) -> ChunkEncoder:
        """A rank file. Pairs of one token follow each other; a match that is a token itself is that token."""
        ranks, chars = read_ranks(path), byte_characters()
        text = {t: "".join(map(chars.__getitem__, t)) for t in ranks}
        model = models.BPE(
            vocab={text[t]: i for t, i in ranks.items()}, merges=[(text[a], text[b]) for a, b in merges_of(ranks)], ignore_merges=True, cache_capacity=0
        )
        tokenizer = Tokenizer(model)
        tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        return cls(tokenizer, **options)

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_new(self, chunks: list[str], together: int = 2048) -> dict[str, bytes]:
        inner = [c for c in chunks if c[0] in SPACES and c[-1] not in SPACES]  # these can stand behind one another
        alone = [c for c in chunks if c[0] not in SPACES or c[-1] in SPACES]
        found = dict(zip(alone, self._plain(alone), strict=True))
        for start in range(0, len(inner), together):
            part = inner[start : start + together]
            raw = self._plain(["".join(part)])[0]
            ends = np.cumsum(self.widths[np.frombuffer(raw, "<u4")])
            wanted = np.cumsum(np.fromiter(map(len, map(str.encode, part)), np.int64, len(part)))
            cut = np.searchsorted(ends, wanted)
            if not np.array_equal(ends[cut], wanted):
                raise AssertionError("a token reaches over the start of a chunk")
            cut = ((cut + 1) * 4).tolist()
            found.update(zip(part, [raw[a:b] for a, b in zip([0, *cut[:-1]], cut)], strict=True))
        return found

    def _segments(self, text: str) -> list[str | bytes]:
        """Chunks of a text; special tokens in it are given as their ids' bytes."""
        if self.split is None or not any(s in text for s in self.special):
            return CHUNK.findall(text)
        out: list[str | bytes] = []
        for part in self.split.split(text):
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            else:
                out += CHUNK.findall(part)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. The cyclic collector waits meanwhile: nothing here makes a cycle, and it would walk the whole cache."""
        waits = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if waits:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self.cache) > self.size // 2:
            self.older, self.cache = self.cache, {}
        known, older, out, open_ = self.cache, self.older, [None] * len(texts), []
        new: set[str | bytes] = set()
        for k, text in enumerate(texts):
            chunks = self._segments(text)
            ids = list(map(known.get, chunks))
            missing, at = [], -1
            for _ in range(ids.count(None)):
                at = ids.index(None, at + 1)
                missing.append(at)
            if not missing:
                out[k] = b"".join(ids)
                continue
            open_.append((k, chunks, ids, missing))
            new.update([chunks[i] for i in missing])
        if not open_:
            return out
        found: dict[str | bytes, bytes] = {}
        fresh, stems = [], []
        for c in new:
            if (held := older.get(c)) is not None:
                found[c] = held
            elif isinstance(c, bytes):  # special ids
                found[c] = c
            elif c[-1] in MARKS and (s := c.rstrip(MARKS))[-1:].isalpha():
                stems.append((c, s, c[len(s) :]))
            else:
                fresh.append(c)
        parts = {p for _, s, m in stems for p in (s, m)}.difference(found, fresh)
        for p in parts:
            if (held := known.get(p) or older.get(p)) is not None:
                found[p] = held
            else:
                fresh.append(p)
        found.update(self._encode_new(fresh))
        found.update([(c, found[s] + found[m]) for c, s, m in stems])
        known.update(found)
        for k, chunks, ids, missing in open_:
            for i in missing:
                ids[i] = found[chunks[i]]
            out[k] = b"".join(ids)
        for c in [c for c in found if len(c) > self.longest]:
            del known[c]
        return out

"""Plain single-process versions that the distributed operators must agree with."""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict

import xxhash


def simhash(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values: list[int], radius: int) -> list[int]:
    """Smallest place reachable from each place over pairs within `radius` bits."""
    root = list(range(len(values)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(values):
        for j in range(i):
            if (x ^ values[j]).bit_count() <= radius:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(values))]


def ppm_bits(training: dict[str, list[bytes]], text: bytes) -> dict[str, float]:
    """Code length of a text in each language: one symbol at a time over dictionaries of contexts of order 0 to 3."""
    import math

    seen = {b for texts in training.values() for t in texts for b in t}
    out = {}
    for lang, texts in training.items():
        count = defaultdict(lambda: defaultdict(int))
        for t in texts:
            for i, b in enumerate(t):
                for order in range(4):
                    if i >= order:
                        count[t[i - order : i]][b] += 1

        def probability(b: int, context: bytes, count=count) -> float:
            """Of byte b, where the bytes of no text share what is left as one symbol."""
            below = (lambda c: probability(c, context[1:])) if context else (lambda c: 1 / 256)
            here = count.get(context)
            if not here:
                return below(b)
            total, kinds = sum(here.values()), len(here)
            if b in here:
                return here[b] / (total + kinds)
            left = 1 - sum(below(c) for c in here)
            return kinds / (total + kinds) * below(b) / left

        bits = 0.0
        for i, b in enumerate(text):
            # a context ends at the edge of the text and at any byte that no training text holds
            context = text[max(0, i - 3) : i]
            for k in range(len(context) - 1, -1, -1):
                if context[k] not in seen:
                    context = context[k + 1 :]
                    break
            bits -= math.log2(probability(b, context))
        out[lang] = bits
    return out


def fold_of(doc_id: int, of: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % of


def plant(doc_id: int, words: list[str]) -> list[str]:
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def runs(words: list, least: int = 24, repeats: int = 3) -> list[tuple[int, int, int]]:
    """Every lag, every place: maximal stretches of words that come again `q` later, smallest periods only."""
    n, out = len(words), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, repeats * q):
                part = words[i : j + q]
                if not any(part[k:] == part[:-k] for k in range(1, q)):
                    out[i, q] = (i, len(part), q)
            i = max(j, i + 1)
    return [out[k] for k in sorted(out)]


def collapse(words: list[str], found: list[tuple[int, int, int]]) -> list[str]:
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in found)]


def word_table(rows: list[tuple[int, str | None]]) -> dict[str, int]:
    """Counts of the words of at least six letters and five occurrences, with the planted typos."""
    count = defaultdict(int)
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}


def near(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced code point."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def forms(count: dict[str, int]) -> set[tuple]:
    by_size = defaultdict(list)
    for w in count:
        by_size[len(w)].append(w)
    rows, form = {}, {}
    for w, n in count.items():
        others = [o for size in (len(w) - 1, len(w), len(w) + 1) for o in by_size[size] if near(w, o)]
        best = min(others, key=lambda o: (-count[o], o), default=None)
        form[w] = best if best is not None and count[best] >= 5 * n else None
        rows[w] = len(others)
    out = set()
    for w, n in count.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, rows[w], count.get(form[w])))
    return out


def without_repeats(rows: list[tuple], window: int) -> list[tuple]:
    """(id, bytes, removed stretches, bytes left) of texts in corpus order: every window is looked up among all earlier ones."""
    seen, out = set(), []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - window + 1):
            w = raw[i : i + window]
            if w in seen:
                gone[i : i + window] = bytes([1]) * window
            seen.add(w)
        spans = [(m.start(), m.end()) for m in re.finditer(b"\x01+", bytes(gone))]
        out.append((doc_id, len(raw), spans, bytes(b for b, g in zip(raw, gone) if not g)))
    return out


def split_cost(parts: tuple[str, ...], counts: dict[str, int], total: int) -> float:
    return sum(math.log(total / counts[w]) if w in counts else math.log(total) + len(w) * math.log(10) for w in parts)


def best_split(name: str, counts: dict[str, int], total: int) -> tuple[str, ...]:
    """Of all ways to cut a name the cheapest, by trying every start of the last part (an unknown part has any length)."""
    best: list[tuple[float, tuple[str, ...]]] = [(0.0, ())]
    for j in range(1, len(name) + 1):
        best.append(min(((best[i][0] + split_cost((name[i:j],), counts, total), (*best[i][1], name[i:j])) for i in range(j)), key=lambda x: x[0]))
    return best[-1][1]


def url_verdicts(rows: list[tuple], rules: list[tuple[str, str]]) -> dict[int, tuple]:
    """{page_id: (host, path, rule, verdict)}: rules, then naive Bayes over the words of host and path, one url after the other."""
    import regex

    counts: dict[str, int] = defaultdict(int)
    for _, _, html in rows:
        for w in regex.findall(r"\p{L}+", regex.sub(r"(?s)<script.*?</script>|<style.*?</style>|<[^>]*>", " ", (html or "").lower())):
            counts[w] += 1
    total = sum(counts.values())
    parsed, seen, splits = {}, {"block": defaultdict(int), "allow": defaultdict(int)}, {}
    for page_id, url, _ in rows:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
        fits = [(len(r), r, what) for r, what in rules for own, start in [(r[: r.index("/")], r[r.index("/") :])]
                if (host == own or host.endswith("." + own)) and path.startswith(start)]
        rule, ruled = max(fits)[1:] if fits else (None, None)
        tokens = []
        for mark, body in (("h:", host), ("p:", path.lower())):
            for name in re.findall(r"[^\W_]+", body):
                if name.isdigit():
                    tokens.append(mark + "0")
                    continue
                if name not in splits:
                    splits[name] = best_split(name, counts, total)
                tokens += [mark + w for w in splits[name]]
        parsed[page_id] = host, path, rule, ruled, tokens
        for t in tokens if ruled else ():
            seen[ruled][t] += 1
    space = len({*seen["block"], *seen["allow"]}) + 1
    size = {k: sum(v.values()) + space for k, v in seen.items()}
    out = {}
    for page_id, (host, path, rule, ruled, tokens) in parsed.items():
        odds = math.fsum(math.log((seen["block"][t] + 1) / size["block"]) - math.log((seen["allow"][t] + 1) / size["allow"]) for t in tokens)
        out[page_id] = host, path, rule, ruled or ("block" if odds > 0 else "allow"), odds
    return out


def quality_terms(text: bytes, grams: int, gaps: int, terms: int) -> list[int]:
    """Term counts of one text by plain loops, with integers of any size cut to 64 bits."""
    wrap, base = (1 << 64) - 1, 0x9E3779B97F4A7C15

    def spread(h: int, size: int) -> int:
        h = (h ^ h >> 29) * 0xBF58476D1CE4E5B9 & wrap
        return (h >> 33) % size

    out, last, before, rest = [0] * terms, {}, None, terms - grams - gaps
    for i in range(len(text) - 2):
        out[spread((text[i] << 16 | text[i + 1] << 8 | text[i + 2]) * base & wrap, grams)] += 1
    for place, word in enumerate(re.findall(rb"[^\x20\x09-\x0D]+", text)):
        h = sum((b + 1) * base**k for k, b in enumerate(word)) & wrap
        out[grams + spread(h, rest)] += 1
        if before is not None:
            out[grams + spread(before * 31 + h & wrap, rest)] += 1
        out[terms - gaps + (min((place - last[word]).bit_length(), gaps - 1) if word in last else 0)] += 1
        last[word], before = place, h
    return out

"""Plain versions of the operators and small tables with awkward rows."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
STRIP = " \t\n\x0b\x0c\r"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def awkward(spark):
    """Null, empty, blank, very long, repeated and clashing; ids may be null or negative."""
    long = "word and more words. " * 20_000
    rows = [(1, None, None, None), (2, "", "en", "s1"), (3, " \t\n ", "en", "s1"), (4, "a", "en", None),
            (5, long, "en", "s2"), (6, "same text here, twice in all", "en", "s2"),
            (6, "same text here, twice in all", "en", "s2"), (None, "a row without an id", "en", "s2"),
            (-7, "Ünïcödé straße \U0001f600 日本語", "de", "ü"), (8, "a\x00b\r\nc\x85d", None, "s1"),
            (9, "x" * 50_000, "en", "s1"), (10, "12345 67 !!", "en", "s1")]
    df = spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], DOCS)
    for name in ("key", "fp", "start", "end", "size", "its", "spans", "h1", "label", "ids.x"):
        df = df.withColumn(name, df["n_chars"])
    return df


def brute_lines(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, str]]:
    """doc_id -> (lines, dropped, kept text); ids are distinct."""
    holders = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            key = lower(line.strip(STRIP))
            if len(key) >= 20:
                holders[key].add(i)
    out = {}
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            held = holders.get(lower(line.strip(STRIP)), ())
            if len(held) < 3 or i == max(held):
                kept.append(line)
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def brute_fingerprint(text: str | None) -> int:
    import xxhash
    words = WORD.findall(lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints: dict[int, int], radius: int = 4) -> dict[int, int]:
    """doc_id -> smallest doc_id that can be reached."""
    ids, root = sorted(prints), {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def brute_targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [
        s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, free, out = 1.5 * sum(sizes.values()), set(sizes), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * sizes[s]]
        if not over:
            return out | {s: level * weight[s] for s in free}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            free.remove(s)
    return out

"""Small tables and brute-force versions for the text operators."""

from __future__ import annotations

import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, texts, start: int = 0):
    """A documents table with columns whose names the operators use inside."""
    rows = [(start + i, t, None if t is None else "en", "x", i, "clash", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, ids string, label int").repartition(3)


def prose(rng: random.Random, n: int, vocabulary: int = 300) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def shingles(text: str | None, n: int, lower: bool = True) -> frozenset:
    words = WORDS.findall((text or "").translate(LOWER) if lower else text or "")
    if len(words) >= n:
        return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def near_components(texts: dict, n: int, percent: int, lower: bool = True) -> dict:
    """Least id reachable over links of enough similarity, by all pairs."""
    sets = {i: shingles(t, n, lower) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            common = len(sets[i] & sets[j])
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in texts}


def edited(rng: random.Random, words: list[str], edits: int) -> list[str]:
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words

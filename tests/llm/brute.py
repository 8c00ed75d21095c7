"""Plain Python versions of what the corpus operators compute."""

from __future__ import annotations

import random
import re
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text: str | None, size: int, word: re.Pattern = BLANK_WORD) -> frozenset:
    found = word.findall((text or "").translate(LOWER))
    if len(found) < size:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(zip(*[found[i:] for i in range(size)]))


def groups(texts: dict[int, str | None], size: int, percent: int) -> dict[int, tuple[int, int]]:
    """Shingles and smallest linked id of each document, from all pairs."""
    sets = {i: shingles(t, size) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def base_rules(text: str | None) -> tuple:
    text = text or ""
    words = BLANK_WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if BLANK_WORD.search(x)]
    n, repeats = len(words), len(covered)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        repeats,
        n < 50 or 100 * repeats > 50 * n,
    )


def licence_places(text: str | None) -> tuple:
    words = PLAIN_WORD.findall((text or "").translate(LOWER))
    found = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        parts = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    starts = [i for i, _ in found]
    labels = ",".join(sorted({label for _, label in found}))
    return len(words), len(found), min(starts, default=None), max(starts, default=None), labels


SYLLABLES = "an be co da el fi go ha in jo ka lo mu ne or pa qui ra su ti un vo wa xe yo zu".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    common = ["the", "of", "and", "to", "in"]
    words = []
    for _ in range(n):
        words.append(rng.choice(common) if rng.random() < 0.4 else "".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))))
        if rng.random() < 0.08:
            words[-1] += rng.choice([".", ",", ".\n"]) if rng.random() < 0.9 else "."
    return " ".join(words)

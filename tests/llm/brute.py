"""What the operators have to give, by definition, one document after another."""

from __future__ import annotations

import re
from collections import defaultdict


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(text: str | None, k: int = 5) -> set[tuple]:
    w = words(text)
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def components(docs: list[tuple[int | None, str | None]]) -> list[tuple[int, int | None]]:
    """Per row: size of its set, smallest id that links of 0.75 reach."""
    sets = [shingles(t) for _, t in docs]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    shared = defaultdict(int)
    for rows in holders.values():
        for y in range(len(rows)):
            for x in range(y):
                shared[rows[x], rows[y]] += 1
    parent = list(range(len(docs)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for (x, y), n in shared.items():
        if 100 * n >= 75 * (len(sets[x]) + len(sets[y]) - n):
            parent[find(x)] = find(y)
    least: dict[int, int | None] = {}
    for i, (doc, _) in enumerate(docs):
        known = least.get(find(i))
        least[find(i)] = doc if known is None else known if doc is None else min(doc, known)
    return [(len(sets[i]), least[find(i)]) for i in range(len(docs))]


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def article_text(html: str) -> str:
    """The generated pages' article, by their fixed markup."""
    import html as references

    inner = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    inner = re.sub(r"</?b>", "", inner.replace("<br>", " "))
    parts = [" ".join(references.unescape(x).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(x for x in parts if x)


def license_facts(text: str | None, phrases: dict[str, str], rules: list, confidence: list[float]):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    starts, labels = [], set()
    for phrase, label in phrases.items():
        q = phrase.split()
        for i in range(len(w) - len(q) + 1):
            if w[i : i + len(q)] == q:
                starts.append(i)
                labels.add(label)
    line = f" {' '.join(w)} " if w else " "
    found = [(m.start(), m.end(), r.priority, k, r.label) for k, r in enumerate(rules) for m in re.finditer(r.pattern, line)]

    def beaten(d) -> bool:
        for e in found:
            if e[0] <= d[0] and e[1] >= d[1]:
                longer = e[1] - e[0] > d[1] - d[0]
                if (longer and e[2] <= d[2]) or (not longer and e[2:4] < d[2:4]):
                    return True
        return False

    kept = [d for d in found if not beaten(d)]
    best = min((d[2] for d in kept), default=None)
    score = confidence[best] if best is not None else 0.5 if labels else 0.0
    both = ",".join(sorted(labels | {d[4] for d in kept}))
    spans = sorted((d[4], line[: d[0]].count(" ") - 1, line[d[0] : d[1]].count(" ") + 1) for d in kept)
    return (len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)), both, score), spans

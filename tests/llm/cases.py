"""Small tables with everything that a real one may hold, and plain versions of what the operators compute."""

from __future__ import annotations

import hashlib
import random
import re
import string

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Column names that the operators use inside or return; a table may have them too.
CLASHING = ["text_sha256", "keep_id", "n", "mark", "names", "rep", "component_id", "sequence_id", "score", "part"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


def lower(text: str | None) -> str:
    return (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


def messy_texts() -> dict[int, str | None]:
    draw = random.Random(7)
    vocabulary = ["".join(draw.choices("abcdeé", k=draw.randint(1, 6))) for _ in range(400)]

    def prose(count: int) -> list[str]:
        return draw.choices(vocabulary, k=count)

    long, passage = prose(20_000), prose(70)
    base = prose(300)
    near = [base, *[base[: 20 * i] + ["edited"] + base[20 * i + 1 :] for i in range(1, 9)]]
    texts: list[str | None] = [None, "", "  \n\t ", "one two three", "ONE two three", "one two three", "É é", "é É"]
    texts += [" ".join(long), " ".join(long[:9_000] + ["other"] + long[9_001:])]
    texts += ["a " * 500, "a " * 300 + "b", "a b " * 200, "b" * 5_000, "b" * 100, "x" * 199, "x" * 200, "y" * 201]
    texts += [" ".join(prose(draw.randint(0, 80)) + passage + prose(draw.randint(0, 80))) for _ in range(40)]
    texts += [" ".join(words) for words in near] + [" ".join(base).upper(), "\n".join(base)]
    texts += [" ".join(prose(n)) for n in range(1, 16)]
    texts += [" ".join(base[k : k + 8] + ["end"] * (k % 2)) for k in range(6)] + [" ".join(passage)] * 30
    return {i * 3 + 1: t for i, t in enumerate(texts)}


def table(spark, texts: dict[int, str | None], parts: int = 5):
    rows = [(i, t, ["en", "de", None][i % 3], "s", None, *["x"] * len(CLASHING)) for i, t in texts.items()]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts, "doc_id")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def components(links: dict[int, set[int]]) -> dict[int, int]:
    out: dict[int, int] = {}
    for start in sorted(links):
        waiting = [start]
        while waiting:
            i = waiting.pop()
            if i not in out:
                out[i] = start
                waiting += links[i]
    return out


def shingles(text: str | None, size: int = 4) -> frozenset:
    words = WORD.findall(lower(text))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def jaccard(texts: dict[int, str | None], percent: int = 85) -> dict[int, tuple[int, int]]:
    sets = {i: shingles(t) for i, t in texts.items()}
    links = {
        i: {
            j
            for j, b in sets.items()
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b)
        }
        for i, a in sets.items()
    }
    found = components({i: js | {i} for i, js in links.items()})
    return {i: (len(sets[i]), found[i]) for i in sets}


def passages(texts: dict[int, str | None], window: int = 13) -> dict[int, tuple[int, int, str]]:
    words = {i: WORD.findall(t or "") for i, t in texts.items()}
    first: dict[tuple, int] = {}
    for i in sorted(words):
        for p in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][p : p + window]), i)
    out = {}
    for i, ws in words.items():
        gone = [False] * len(ws)
        for p in range(len(ws) - window + 1):
            if first[tuple(ws[p : p + window])] < i:
                gone[p : p + window] = [True] * window
        kept = " ".join(w for w, g in zip(ws, gone, strict=True) if not g)
        out[i] = (len(ws), sum(gone), sha(kept.encode()))
    return out


def strings(texts: dict[int, str | None], window: int = 200) -> dict[int, tuple[int, int, int, str]]:
    data = {i: (t or "").encode() for i, t in texts.items()}
    seen: dict[bytes, int] = {}
    for t in data.values():
        for p in range(len(t) - window + 1):
            seen[t[p : p + window]] = seen.get(t[p : p + window], 0) + 1
    out = {}
    for i, t in data.items():
        gone = bytearray(len(t))
        for p in range(len(t) - window + 1):
            if seen[t[p : p + window]] > 1:
                gone[p : p + window] = b"\1" * window
        spans = sum(1 for p, g in enumerate(gone) if g and (p == 0 or not gone[p - 1]))
        out[i] = (len(t), sum(gone), spans, sha(bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return out

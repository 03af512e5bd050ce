"""Plain, slow versions of the operators, to compare results with on small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def line_dedup(docs, least=10):
    keys = {row: [line.strip("\t\n\x0b\x0c\r ").translate(ASCII_LOWER)
                  for line in (text or "").split("\n")] for row, (_, text) in enumerate(docs)}
    seen = defaultdict(set)
    for row, found in keys.items():
        for key in found:
            seen[key].add(row)
    out = []
    for row, (doc_id, text) in enumerate(docs):
        lines = (text or "").split("\n")
        kept = [line for line, key in zip(lines, keys[row], strict=True)
                if not key or len(seen[key]) < least]
        out.append((doc_id, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def shingle_set(text, size):
    found = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(ASCII_LOWER))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i:i + size]) for i in range(max(1, len(found) - size + 1)))


def jaccard_components(docs, size, num, den):
    sets = [shingle_set(text, size) for _, text in docs]
    lists = defaultdict(list)
    for row, own in enumerate(sets):
        for shingle in own:
            lists[shingle].append(row)
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for row, own in enumerate(sets):
        overlap = defaultdict(int)
        for shingle in own:
            for other in lists[shingle]:
                if other < row:
                    overlap[other] += 1
        for other, common in overlap.items():
            if den * common >= num * (len(own) + len(sets[other]) - common):
                parent[root(row)] = root(other)
    least = {}
    for row, (doc_id, _) in enumerate(docs):
        r = root(row)
        least[r] = min(least.get(r, doc_id), doc_id)
    return [(doc_id, len(sets[row]), least[root(row)]) for row, (doc_id, _) in enumerate(docs)]


def benchmark_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(ASCII_LOWER))


def contamination(docs, items, window=10):
    windows = defaultdict(set)
    for item_id, text in items:
        found = benchmark_words(text)
        size = min(window, len(found))
        for i in range(len(found) - size + 1 if size else 0):
            windows[tuple(found[i:i + size])].add(str(item_id))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        found = benchmark_words(text)
        hit, ids = set(), set()
        for size in sizes:
            for i in range(len(found) - size + 1):
                if own := windows.get(tuple(found[i:i + size])):
                    hit.update(range(i, i + size))
                    ids |= own
        out.append((doc_id, len(found), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit)))
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    text = text or ""
    spans = [("email", *m.span()) for m in EMAIL.finditer(text)]
    spans += [("ip", *m.span()) for m in IP.finditer(text)
              if all(int(p) <= 255 for p in m.group().split("."))]
    for kind, pattern, least, most in (("card", CARD, 12, 19), ("phone", PHONE, 9, 15)):
        for m in pattern.finditer(text):
            digits = "".join(re.findall("[0-9]", m.group()))
            if least <= len(digits) <= most and (kind == "phone" or luhn(digits)):
                spans.append((kind, *m.span()))
    kinds = ("email", "ip", "card", "phone")
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0])))

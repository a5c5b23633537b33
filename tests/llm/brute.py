"""Plain versions of the operators' results, for small inputs."""

import re
import zlib

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes(i + 32 if 65 <= i < 91 else i for i in range(256))


def words(text):
    return WORD.findall((text or "").encode().translate(LOWER))


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(texts: dict, percent=85):
    sets = {k: shingle_set(v) for k, v in texts.items()}
    parent = {k: k for k in texts}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: root(k) for k in keys}, sets


def edit_distance_within(pattern, text):
    """Least edit distance of the pattern to any stretch of the text."""
    prev = [0] * (len(text) + 1)
    for i in range(1, len(pattern) + 1):
        cur = [i] + [0] * len(text)
        for j in range(1, len(text) + 1):
            cur[j] = min(prev[j - 1] + (pattern[i - 1] != text[j - 1]), prev[j] + 1, cur[j - 1] + 1)
        prev = cur
    return min(prev)


def in_training(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 != 1


PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def personal(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")), "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]():
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out

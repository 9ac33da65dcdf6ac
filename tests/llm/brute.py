"""Plain versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def components(docs):
    """{doc_id: (size, component)} of distinct ids."""
    sets = {d: shingles(t) for d, t in docs}
    held = defaultdict(list)
    for d, own in sets.items():
        for s in own:
            held[s].append(d)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for d in sorted(sets):
        common = Counter(e for s in sets[d] for e in held[s] if e > d)
        for e, n in common.items():
            if 100 * n >= 80 * (len(sets[d]) + len(sets[e]) - n):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d)) for d in sets}


def pieces(text, tokenizer, size=2048):
    """(piece, start, length, crc) of a text."""
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
    head = (len(ids) - 1) % size + 1
    edges = [0, *range(head, len(ids) + 1, size)]
    return [
        (k, a, b - a, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[a:b])))
        for k, (a, b) in enumerate(zip(edges, edges[1:]))
    ]


def kept_lines(docs):
    """Per row (doc_id, lines, dropped, sha256)."""
    white = " \t\n\x0b\x0c\r"
    key = lambda line: line.strip(white).translate(ASCII_LOWER)
    held = defaultdict(set)
    for d, t in docs:
        if d is not None:
            for line in (t or "").split("\n"):
                if len(key(line)) >= 10:
                    held[key(line)].add(d)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        stay = [x for x in lines if d is None or len(held[key(x)]) < 2 or min(held[key(x)]) == d]
        text = "\n".join(stay)
        out.append((d, len(lines), len(lines) - len(stay), hashlib.sha256(text.encode()).hexdigest()))
    return out


def base_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
                if not 13 <= len(digits) <= 19 or sum(n // 10 + n % 10 for n in doubled) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((kind, m.start(), m.end()))
    return found


def verdict(url, rules):
    """(host, path, rule, verdict) by trying every rule."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = host.translate(ASCII_LOWER)
    fits = [
        (len(h + p), h + p, v) for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits) if fits else (0, None, "allow")
    return host, path, best[1], best[2]

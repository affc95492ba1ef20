"""Plain versions of the operators, for small tables."""

import collections
import hashlib
import re


def shingle_set(text, size, lower=True):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if len(words) >= size else frozenset([tuple(words)])


def similar(rows, size, percent):
    """(id, set size, smallest linked id) per row; null ids are largest."""
    sets = [shingle_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                root[find(i)] = find(j)
    low = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)].append(d)
    return [(d, len(s), (min(low[find(i)]) if low[find(i)] else None) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def without_repeats(rows, window=20):
    """(id, words, removed, digest of what stays) per row, by rows of one id at a time."""
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0]))
    at = 0
    while at < len(order):
        same = [i for i in order[at:] if rows[i][0] == rows[order[at]][0]]
        new = set()
        for i in same:
            words = (rows[i][1] or "").encode().split()
            gone, own = [False] * len(words), set()
            for s in range(len(words) - window + 1):
                key = tuple(words[s : s + window])
                if key in seen or key in own:
                    gone[s : s + window] = [True] * window
                own.add(key)
            new |= own
            kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
            out.append((rows[i][0], len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
        seen |= new
        at += len(same)
    return out


def text_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = collections.Counter(windows)
    repeated = {p for i, w in enumerate(windows) if count[w] > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def distance(pattern, text):
    """Edits of the whole pattern against its best place in the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        pairs = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(sum(map(int, str(p))) for p in pairs) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def personal(text):
    found = [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m[0])]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))


def judged(url, rules=RULES):
    host = path = ""
    if url is not None and "://" in url:
        host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]

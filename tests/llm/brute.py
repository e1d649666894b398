"""Plain Python forms that the operators are held against."""

import collections
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(t or "")


def shingle_set(t, k=5):
    w = words(t)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


class Union:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        self.up[self.find(a)] = self.find(b)

    def groups(self):
        out = collections.defaultdict(set)
        for x in self.up:
            out[self.find(x)].add(x)
        return {frozenset(v) for v in out.values()}


def near_classes(docs, threshold=0.8):
    """Components over doc_id -> text by exact Jaccard."""
    u, sets = Union(docs), {d: shingle_set(t) for d, t in docs.items()}
    by = collections.defaultdict(list)
    for d, t in docs.items():
        by[t or ""].append(d)
    for v in by.values():
        for x in v[1:]:
            u.join(v[0], x)
    heads = [v[0] for v in by.values()]
    posting = collections.defaultdict(list)
    for d in heads:
        for s in sets[d]:
            posting[s].append(d)
    seen = set()
    for v in posting.values():
        for i, a in enumerate(v):
            for b in v[i + 1:]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    if jaccard(sets[a], sets[b]) >= threshold:
                        u.join(a, b)
    return u.groups()


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return re.sub(r"[^0-9]", "", s)


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(d[::-1])) % 10 == 0


def base_spans(t):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(t) if 12 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 9 <= len(digits(m.group())) <= 15]
    return sorted(out)


def quality(t):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    t = t or ""
    w = words(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    c = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    mark = set()
    for k in range(len(w) - 2):
        if c[tuple(w[k:k + 3])] > 1:
            mark |= {k, k + 1, k + 2}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(mark))


def boilerplate(rows, min_sites):
    """(doc_id, text, site) with distinct (doc_id, text): cleaned texts by doc_id."""
    import hashlib

    sites, first = collections.defaultdict(set), {}
    strip = " \t\n\x0b\x0c\r"
    for d, t, s in rows:
        key = hashlib.md5(f"{d if d is not None else chr(2)}\x01{t or ''}".encode()).hexdigest()
        for i, x in enumerate((t or "").split("\n")):
            x = x.strip(strip)
            if x:
                sites[x].add(s)
                first[x] = min(first.get(x, (key, i)), (key, i))
    out = {}
    for d, t, s in rows:
        key = hashlib.md5(f"{d if d is not None else chr(2)}\x01{t or ''}".encode()).hexdigest()
        kept = [x for i, x in enumerate((t or "").split("\n"))
                if not (x.strip(strip) and len(sites[x.strip(strip)]) >= min_sites and first[x.strip(strip)] != (key, i))]
        out[d] = "\n".join(kept)
    return out

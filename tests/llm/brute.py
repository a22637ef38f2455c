"""The contracts in plain Python, over lists of (doc_id, text): slow, and as simple as can be."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def covered(starts, length):
    return {i for s in starts for i in range(s, s + length)}


def op1(docs):
    rows = []
    for doc, text in docs:
        own = words(text)
        windows = Counter(tuple(own[i:i + 8]) for i in range(len(own) - 7))
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        repeat = len(covered([i for i in range(len(own) - 7) if windows[tuple(own[i:i + 8])] > 1], 8))
        rows.append((doc, len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), repeat,
                     len(own) < 20 or 100 * repeat > 30 * len(own)))
    return rows


def op4(docs):
    first = {}
    for doc, text in docs:
        own = words(text)
        for i in range(len(own) - 12) if doc is not None else ():
            key = tuple(own[i:i + 13])
            first[key] = min(first.get(key, doc), doc)
    rows = []
    for doc, text in docs:
        own = words(text)
        gone = covered([i for i in range(len(own) - 12) if doc is not None and first[tuple(own[i:i + 13])] < doc], 13)
        rows.append((doc, len(own), len(gone), sha(" ".join(w for i, w in enumerate(own) if i not in gone))))
    return rows


def op5(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        own = ITEM_WORD.findall(lower(text))
        for i in range(max(1, len(own) - 9)) if own else ():
            windows[tuple(own[i:i + 10])].add(str(item))
    lengths = {len(w) for w in windows}
    rows = []
    for doc, text in docs:
        own = ITEM_WORD.findall(lower(text))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(own) - n + 1):
                if (key := tuple(own[i:i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[key]
        rows.append((doc, len(own), len(hit), len(found), sha(",".join(sorted(found))), len(hit) > 0))
    return rows


def shingles(text):
    own = words(lower(text))
    return {tuple(own[i:i + 5]) for i in range(max(1, len(own) - 4))} if own else set()


def op7(docs):
    sets = [shingles(text) for _, text in docs]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    root = {doc: doc for doc, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x] if j < i)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n) and None not in (docs[i][0], docs[j][0]):
                a, b = sorted((find(docs[i][0]), find(docs[j][0])))
                root[b] = a
    return [(doc, len(s), None if doc is None else find(doc)) for (doc, _), s in zip(docs, sets, strict=True)]


def held_out(doc, mod, rest):
    return doc is not None and zlib.crc32(str(doc).encode()) % mod == rest


def op8(docs):
    tokens = lambda text: [*words(lower(text)), None]
    counts = Counter(t for doc, text in docs if doc is not None and not held_out(doc, 5, 1) for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    rows = []
    for doc, text in docs:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in own)
        rows.append((doc, held_out(doc, 5, 1), len(own), sum(counts[t] > 0 for t in own), total, base))
    return rows

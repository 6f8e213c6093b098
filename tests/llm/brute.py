"""Plain Python versions of the operators, and small awkward tables."""

import collections
import hashlib
import math
import random
import re
import zlib

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\n\x0b\x0c\r"
CLASHES = ["row", "words", "own", "n", "h", "e", "a", "b", "d", "k", "score", "kept", "items", "id", "hash of text", "first"]


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def documents(seed=3):
    """(doc_id, text): copies, near copies, shared lines, short, empty, blank, null and long texts, repeated rows."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeéöñ") for _ in range(rnd.randint(1, 7))) for _ in range(400)]
    word = lambda: rnd.choice(vocabulary)
    line = lambda n: " ".join(word() for _ in range(n))
    shared = [line(14) for _ in range(4)]
    rows, i = [], 0
    for _ in range(40):
        lines = [line(rnd.randint(1, 30)) for _ in range(rnd.randint(1, 9))] + rnd.sample(shared, rnd.randint(0, 2))
        rnd.shuffle(lines)
        rows.append((i, "\n".join(lines)))
        i += 1
        words = "\n".join(lines).split(" ")
        for _ in range(rnd.choice([0, 0, 1, 3])):
            near = list(words)
            for _ in range(rnd.randint(0, max(1, len(words) // 25))):
                near[rnd.randrange(len(near))] = word()
            rows.append((i, " ".join(near)))
            i += 1
    for text in (None, "", "  \t\n ", "one", "One", "one two three", "a b c d e", "A b C d e", "  " + shared[0].upper() + " \r",
                 "\n".join([shared[1]] * 3), line(6) + "\n\n\n", "x" * 900, "\n".join([line(9)] * 40)):
        rows.append((i, text))
        i += 1
    rows.append((i, "\n".join(line(40) for _ in range(120))))
    rows += [rows[0], rows[0], rows[5]]
    return rows


def line_dedup(rows):
    split = [(d, (t or "").split("\n")) for d, t in rows]
    key = lambda x: x.strip(SPACE).translate(LOWER)
    held = collections.defaultdict(list)
    for d, lines in split:
        for k in {key(x) for x in lines}:
            held[k].append(d)
    out = []
    for d, lines in split:
        kept = [x for x in lines if len(key(x)) < 40 or len(held[key(x)]) < 5 or max(held[key(x)]) == d]
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept)), "\n".join(kept)))
    return out


def near_copies(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                group[top(i)] = top(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[top(i)] = min(low.get(top(i), d), d)
    return [(d, len(sets[i]), low[top(i)]) for i, (d, _) in enumerate(rows)]


def words10(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def decontamination(rows, items):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = words10(text)
        m = min(10, len(w))
        for i in range(len(w) - m + 1 if w else 0):
            windows[tuple(w[i:i + m])].add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for d, t in rows:
        w, hit, found = words10(t), set(), set()
        for m in sizes:
            for i in range(len(w) - m + 1):
                if tuple(w[i:i + m]) in windows:
                    hit.update(range(i, i + m))
                    found |= windows[tuple(w[i:i + m])]
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def repeats(rows, length=400):
    texts = [(t or "").encode() for _, t in rows]
    count = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        gone = [0] * (len(t) + 1)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        kept, depth, spans, before = bytearray(), 0, 0, False
        for i, byte in enumerate(t):
            depth += gone[i]
            spans += depth > 0 and not before
            before = depth > 0
            if not before:
                kept.append(byte)
        out.append((d, len(t), len(t) - len(kept), spans, sha(bytes(kept))))
    return out


def quality_base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    count = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    again = {j for i in range(len(w) - 7) if count[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if x.strip(SPACE)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again),
            len(w) < 20 or 100 * len(again) > 30 * len(w))


def kneser_ney(rows, discounts):
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + ["</s>"]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1
    one, two = collections.Counter(), collections.Counter()
    for d, t in rows:
        if not held(d):
            w = tokens(t)
            one.update(w)
            two.update(zip(["<s>"] + w, w))
    n, v = sum(one.values()), len(one)
    of = collections.Counter(two.values())
    d2 = discounts(*[of[i] for i in (1, 2, 3, 4)])
    follow = collections.Counter(w for _, w in two)
    of = collections.Counter(follow.values())
    d1 = discounts(*[of[i] for i in (1, 2, 3, 4)])
    total, kinds = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0])
    for (u, _), c in two.items():
        total[u] += c
        kinds[u][min(c, 3) - 1] += 1
    off = lambda c, d: d[min(c, 3) - 1] if c else 0
    all_ = sum(follow.values())
    spare = sum(off(c, d1) for c in follow.values()) / all_ if all_ else 1

    def p(w, u):
        low = (follow[w] - off(follow[w], d1)) / max(all_, 1) + spare / (v + 1)
        if not total[u]:
            return low
        return (two[u, w] - off(two[u, w], d2)) / total[u] + sum(x * y for x, y in zip(kinds[u], d2)) / total[u] * low

    out = []
    for d, t in rows:
        w = tokens(t)
        out.append((d, held(d), len(w), sum(one[x] > 0 for x in w), n,
                    sum(math.log10((one[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w),
                    sum(math.log10(p(b, a)) for a, b in zip(["<s>"] + w, w))))
    return out

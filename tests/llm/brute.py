"""Plain restatements of what the queries return, row by row, to hold the operators against."""

import hashlib
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def secrets(text):
    t = text or ""
    spans = [(m.start(), 0, m.end()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    names = ("assign", "access", "hex")
    spans.sort()
    return [sum(k == i for _, k, _ in spans) for i in range(3)], sha(",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans))


def luhn(digits):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def personal(text):
    t = text or ""
    found = {
        "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)],
        "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))],
        "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(d := re.sub(r"[^0-9]", "", m[0])) <= 19 and luhn(d)],
        "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15],
    }
    return [len(x) for x in found.values()], sha(",".join(f"{k}:{a}:{b}" for k, x in found.items() for a, b in x))


def url(u):
    if u is None or "://" not in u:
        return "", "", None, None
    rest = u.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = low(host)
    rules = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
    fit = [(len(h) + len(p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[1:] if fit else (None, None)))


def copies(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(low(t or ""), []).append(i)
    return sorted((i, max(g), len(g), i == max(g), sha(n)) for n, g in groups.items() for i in g)


def quality(text):
    t = text or ""
    w = WORD.findall(t)
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    c = Counter(tri)
    covered = {i + j for i, x in enumerate(tri) if c[x] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n


def features(text):
    """The learner's integers, from plain counts."""
    n, chars, symbols, dup, repeat, _ = quality(text)
    upper = sum("A" <= c <= "Z" for c in text)
    share = lambda a, b: a * 200 // max(b, 1)
    return {"symbol_share": share(symbols, chars), "repeat_share": share(repeat, n), "dup_line_share": share(dup, text.count("\n") + 1), "upper_share": share(upper, chars), "word_length": min(chars * 10 // max(n, 1), 1000), "word_count": min(n // 10, 200)}


def covering(grow, prune, most_rules=12, most_tests=4):
    """Decision list by sequential covering over rows (features, accepted), all thresholds tried one by one."""
    import math

    hit = lambda rule, rows: [(x, y) for x, y in rows if all(x[f] >= t if up else x[f] <= t for f, up, t in rule)]
    bad = lambda rows: sum(not y for _, y in rows)
    out = []
    while len(out) < most_rules:
        rule = ()
        while len(rule) < most_tests:
            left = hit(rule, grow)
            p0, n0 = bad(left), len(left) - bad(left)
            best, test = 1e-9, None
            for f in left[0][0] if p0 and n0 else ():
                for up in (True, False):
                    for t in sorted({x[f] for x, _ in left}, reverse=up):
                        got = hit([(f, up, t)], left)
                        p = bad(got)
                        gain = p * (math.log2(p / len(got)) - math.log2(p0 / (p0 + n0))) if p else 0
                        if gain > best + (1e-9 if test else 0):
                            best, test = gain, (f, up, t)
            if test is None:
                break
            rule += (test,)
        if not rule:
            return out
        worth = lambda r: (lambda g: (2 * bad(g) - len(g)) / len(g) if g else -1.0)(hit(r, prune))
        while len(rule) > 1:
            shorter = max((rule[:i] + rule[i + 1 :] for i in range(len(rule))), key=worth)
            if worth(shorter) < worth(rule):
                break
            rule = shorter
        a, b = hit(rule, grow), hit(rule, prune)
        if bad(a) + bad(b) < 8 or bad(a) < 0.98 * len(a) or bad(b) < 0.98 * len(b):
            return out
        out.append(rule)
        grow, prune = ([r for r in rows if not hit(rule, [r])] for rows in (grow, prune))
    return out


def token_pieces(rows, tokenizer, size=4096):
    out = []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for k, a in enumerate(range(0, len(ids), size)):
            part = ids[a : a + size]
            out.append((i, k, a, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))))
    return sorted(out)


def shingles(text, k=3):
    w = WORD.findall(low(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset({tuple(w)})


def near(rows, k=3, percent=85):
    """doc_id, set size, smallest id reachable by links."""
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = {}
    for n, (_, s) in enumerate(sets):
        seen = Counter(m for x in s for m in index.get(x, ()))
        for m, both in seen.items():
            if 100 * both >= percent * (len(s) + len(sets[m][1]) - both):
                a, b = sorted((root(n), root(m)))
                parent[b] = a
        for x in s:
            index.setdefault(x, []).append(n)
    least = {}
    for n, (i, _) in enumerate(sets):
        least[root(n)] = min(i, least.get(root(n), i))
    return sorted((i, len(s), least[root(n)], i == least[root(n)]) for n, (i, s) in enumerate(sets))


def repeats(rows, k=35):
    docs = [(i, WORD.findall(t or "")) for i, t in rows]
    c = Counter(tuple(w[a : a + k]) for _, w in docs for a in range(len(w) - k + 1))
    out = []
    for i, w in docs:
        gone = set()
        for a in range(len(w) - k + 1):
            if c[tuple(w[a : a + k])] > 1:
                gone |= set(range(a, a + k))
        out.append((i, len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone))))
    return sorted(out)


def failed(rows):
    """Letters of the filters that each row (doc_id, text) fails."""
    first = {}
    for i, t in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    out = []
    for i, t in rows:
        t = t or ""
        w = WORD.findall(t)
        bad = {"A"} if len(w) < 50 else set()
        bad |= {"B"} if 100 * len(set(w)) < 65 * len(w) else set()
        bad |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t) else set()
        bad |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        bad |= {"E"} if i is not None and i > first.get(t, i) else set()
        out.append(bad)
    return out


def audit(rows, parts, good, toxic):
    """(part, order, step, kept, removed, redundant, unique, good lost, toxic lost, shapley), by applying every order to every row."""
    from itertools import permutations

    bad, out, sums = failed(rows), {}, Counter()
    orders = ["".join(p) for p in permutations("ABCDE")]
    for (i, _), b, part in zip(rows, bad, parts):
        for order in orders:
            gone = False
            for step, f in enumerate(order, 1):
                c = out.setdefault((part or "", order, step), [0] * 6)
                if f in b and not gone:
                    gone = True
                    c[1] += 1
                    c[4] += i in good
                    c[5] += i in toxic
                    sums[part or "", f] += 1
                elif f in b:
                    c[2] += 1
                c[0] += not gone
                c[3] += b == {f}
    return sorted((*k, *c, sums[k[0], k[1][k[2] - 1]]) for k, c in out.items())


def divergence(rows, least=10):
    """(lang, source, part, item, value, rank) of rows (text, lang, source)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(t)) for t, _, _ in rows]
    docs, uses, out = Counter(), Counter(), []
    for (_, lang, source), ts in zip(rows, terms):
        docs.update({(lang, t) for t in ts})
        for t in ts:
            uses[lang, source, t] += 1
    for lang in {r[1] for r in rows}:
        kept = [t for (g, t), n in docs.items() if g == lang and n >= least]
        sources = {r[2] for r in rows if r[1] == lang}
        count = lambda s, t: uses[lang, s, t]
        whole = lambda t: sum(count(s, t) for s in sources)

        def part(c):
            n = sum(c.values()) + 2 * len(kept)
            return {t: 1 + 10**9 * (x + 2) // n for t, x in c.items()}

        p = {s: part({t: count(s, t) for t in kept}) for s in sources}
        q = part({t: whole(t) for t in kept})
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            marks = [(t, f(p[s][t], q[t])) for t in kept if count(s, t) and p[s][t] > q[t]]
            for kind, found, most in (("pair", pairs, None), ("term", marks, 10)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, kind, i, v, k) for k, (i, v) in enumerate(found[:most], 1)]
    return sorted(out)

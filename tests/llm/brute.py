"""Plain loops for what the corpus operators compute, for small tables."""

import re
from collections import Counter, defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALPHANUMERIC = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def runs(words, width, whole=True):
    if len(words) < width:
        return frozenset([tuple(words)]) if words and whole else frozenset()
    return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1))


def statistics(text):
    text = text or ""
    words = SPACED.findall(text)
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = set()
    for k in range(len(words) - 4):
        if windows[tuple(words[k : k + 5])] > 1:
            covered.update(range(k, k + 5))
    seen, again = set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            again += line in seen
            seen.add(line)
    n = len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = n < 10 or 100 * len(covered) > 20 * n
    return (n, sum(map(len, words)), symbols, again, len(covered), failed)


def groups(rows, width, num, den):
    """[(doc_id, set size, least id of the component)] of (doc_id, text) rows."""
    sets = [runs(SPACED.findall(lower(t)), width) for _, t in rows]
    holders = defaultdict(list)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in holders[g])
        for j, n in shared.items():
            if den * n >= num * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
        for g in s:
            holders[g].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)]


def without_later_lines(rows, width, num, den):
    """{doc_id: text} of (doc_id, text) rows in order of distinct ids."""
    holders, sets, gone = defaultdict(list), [], set()
    for d, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            s = runs(SPACED.findall(lower(line)), width, whole=False)
            if not s:
                continue
            shared = Counter(x for g in s for x in holders[g])
            if any(den * n >= num * (len(s) + len(sets[x]) - n) for x, n in shared.items()):
                gone.add((d, k))
            for g in s:
                holders[g].append(len(sets))
            sets.append(s)
    out = {}
    for d, text in rows:
        lines = (text or "").split("\n")
        kept = [line for k, line in enumerate(lines) if (d, k) not in gone]
        if len(kept) == len(lines):
            out[d] = text
        elif SPACED.search("\n".join(kept)):
            out[d] = "\n".join(kept)
    return out


def contamination(rows, items, width=13):
    """[(doc_id, words, hit words, item ids)] of (doc_id, text) rows."""
    windows = defaultdict(set)
    for i, text in items:
        for w in runs(ALPHANUMERIC.findall(lower(text)), width):
            windows[w].add(i)
    sizes = {len(w) for w in windows}
    out = []
    for d, text in rows:
        words = ALPHANUMERIC.findall(lower(text))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                own = windows.get(tuple(words[k : k + n]))
                if own:
                    hit.update(range(k, k + n))
                    found |= own
        out.append((d, len(words), len(hit), tuple(sorted(found))))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def personal_data(text):
    """The base spans (start, rank, end, kind), in order."""
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        (
            "card",
            r"[0-9]([\x20-]?[0-9])+",
            lambda m: 14 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m)),
        ),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
    )
    out = []
    for rank, (kind, pattern, ok) in enumerate(kinds):
        out += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "") if ok(m.group())]
    return sorted(out)

"""Plain Python versions of the contracts, for small inputs."""

import hashlib
import re
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def least_roots(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingle_set(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def near_duplicates(rows):
    """doc_id -> (size, component) for rows of (doc_id, text)."""
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    holders = defaultdict(list)
    for i, own in sets.items():
        for x in own:
            holders[x].append(i)
    pairs = defaultdict(int)
    for own in holders.values():
        for k, a in enumerate(own):
            for b in own[k + 1 :]:
                pairs[(a, b)] += 1
    links = [
        (a, b)
        for (a, b), n in pairs.items()
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)
    ]
    roots = least_roots(sets, links)
    return {i: (len(sets[i]), roots[i]) for i in sets}


def alnum_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def contamination(docs, items):
    """One tuple per document, in order."""
    windows = defaultdict(set)
    for item, text in items:
        words = alnum_words(text)
        if words and item is not None:
            for k in range(max(1, len(words) - 9)):
                windows[tuple(words[k : k + 10])].add(str(item))
    out = []
    for _, text in docs:
        words = alnum_words(text)
        hit, found = [False] * len(words), set()
        for n in {len(w) for w in windows}:
            for s in range(len(words) - n + 1):
                own = windows.get(tuple(words[s : s + n]))
                if own:
                    found |= own
                    hit[s : s + n] = [True] * n
        digest = sha(",".join(sorted(found)))
        out.append((len(words), sum(hit), len(found), digest, any(hit)))
    return out


def luhn(digits):
    doubled = [int(d) * 2 if k % 2 else int(d) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text):
    kinds = ["email", "ip", "card", "phone"]
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([ \-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], kinds.index(s[0])))


def mirrored_words():
    """Two words of 1,024 letters that swap a and b: powers of an odd base modulo 2^64 cancel."""
    word = "abba"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))

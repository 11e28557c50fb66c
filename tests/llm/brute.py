"""Plain Python versions of the contracts' definitions, for small fixtures."""

import re

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def words(text):
    return [w for w in re.split(f"[{SPACE}]+", text or "") if w]


def alnum_words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def stats(text):
    w = words(text)
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in lines
            lines.add(line)
    grams = {}
    for i in range(len(w) - 4):
        grams.setdefault(tuple(w[i: i + 5]), []).append(i)
    covered = {j for at in grams.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
            "n_dup_lines": dup, "n_repeat_words": len(covered)}


def hits(text, items, width=13):
    """(n_words, n_hit, sorted ids of items with an occurring window)."""
    w = alnum_words(text)
    hit, found = set(), set()
    for item_id, item in items:
        v = alnum_words(item)
        n = min(len(v), width)
        for i in range(len(v) - n + 1 if v else 0):
            for j in range(len(w) - n + 1):
                if w[j: j + n] == v[i: i + n]:
                    hit.update(range(j, j + n))
                    found.add(str(item_id))
    return len(w), len(hit), sorted(found)

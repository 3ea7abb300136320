"""Plain-Python evaluation of the category and severity rule tables, row
by row: the model the CASE expressions are checked against (and the
Python-UDF side of the bench comparison)."""

from flowlens.functions import classify as C


def category(label):
    if label is None or label == "":
        return C.CATEGORY_EMPTY
    u = label.strip().upper()
    for r in C.CATEGORY_RULES:
        if r.equals:
            hit = u in r.equals
        else:
            hit = any(t in u for t in r.contains)
            hit = hit and all(any(t in u for t in g) for g in r.also)
            hit = hit and not any(t in u for t in r.lacks)
        if hit:
            return r.category
    return C.CATEGORY_DEFAULT


def severity(cat):
    if cat is None or cat == "":
        return C.SEVERITY_DEFAULT
    c = cat.upper()
    if c == C.SEVERITY_BENIGN[0]:
        return C.SEVERITY_BENIGN[1]
    for level, tokens in C.SEVERITY_RULES:
        if any(t in c for t in tokens):
            return level
    return C.SEVERITY_DEFAULT

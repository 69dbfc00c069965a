"""Plain Python versions of the span operators, for the tests."""

import hashlib
import re

ASSIGN = re.compile(
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"
    "[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def luhn(s):
    t = 0
    for i, c in enumerate(reversed(s)):
        v = int(c)
        if i % 2:
            v = v * 2 - (9 if v > 4 else 0)
        t += v
    return t % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


SECRETS = [
    ("assign", ASSIGN, lambda m: len(m[2]) >= 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]
PII = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 8 <= len(digits(m[0])) <= 15),
]


def spans(text, rules):
    return [(k, m.start(), m.end()) for k, p, ok in rules for m in p.finditer(text or "") if ok(m)]


def secret_row(text):
    found = spans(text, SECRETS)
    names = [k for k, _, _ in SECRETS]
    found = sorted(found, key=lambda z: (z[1], names.index(z[0])))
    return (*[sum(k == n for k, _, _ in found) for n in names], sha(found))


def pii_row(text):
    found = spans(text, PII)
    return (*[sum(k == n for k, _, _ in found) for n, _, _ in PII], sha(found))


def sha(found):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest()

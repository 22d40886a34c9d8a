"""Plain Python models of the text operators, written from their specification for tests."""

from __future__ import annotations

import re
import unicodedata


def normalize(t: str) -> str:
    t = unicodedata.normalize("NFKC", t).replace("\r\n", "\n").replace("\r", "\n")
    t = "".join(" " if ord(c) < 32 and c not in "\t\n" else c for c in t)
    for a, b in (("\xad", ""), ("“", '"'), ("”", '"'), ("‘", "'"), ("’", "'")):
        t = t.replace(a, b)
    return re.sub("[ \t]+", " ", t)


def key(line: str) -> str:
    return " ".join(line.strip().lower().split())

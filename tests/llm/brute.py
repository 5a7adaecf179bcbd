"""Plain versions of the span rules, one text at a time."""

import hashlib
import re

BASE9 = ["email", "ip", "card", "phone"]
BASE10 = ["assign", "access", "hex"]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def private_spans(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group(0).split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group(0))
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group(0))) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def credential_spans(text):
    text, out = text or "", []
    names = "|".join(
        "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name)
        for name in ["password", "passwd", "secret", "token", "api_?key"]
    )
    for m in re.finditer(rf"({names})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m.group(2)) >= 12:
            out.append((m.start(), 0, m.end()))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if m.end() - m.start() >= 18:
            out.append((m.start(), 1, m.end()))
    for m in re.finditer("[0-9a-f]+", text):
        if m.end() - m.start() >= 16:
            out.append((m.start(), 2, m.end()))
    return sorted(out)


def digest(spans, names):
    return hashlib.sha256(",".join(f"{names[o]}:{s}:{e}" for s, o, e in spans).encode()).hexdigest()

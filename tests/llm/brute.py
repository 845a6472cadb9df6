"""Plain versions of the operators, to hold their results against."""

import hashlib
import math
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)


def base_secrets(text):
    """(start, kind, end) of the base findings, in order."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def redacted(text, spans, mark="[secret]"):
    out, done = "", 0
    for a, _, b in spans:
        if a >= done:
            out += text[done:a] + mark
        done = max(done, b)
    return out + text[done:]


def rules(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = {w for w in windows if windows.count(w) > 1} if len(windows) < 200 else {w for w, n in __import__("collections").Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in many for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def targets(sizes, weights=(5, 2, 1), epochs=3):
    """Targets of source sizes (in order) by resharing the excess until none is above."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    cap, full = [epochs * s for s in sizes], set()
    while True:
        left = sum(sizes) - sum(cap[i] for i in full)
        share = sum(w[i] for i in range(len(sizes)) if i not in full)
        out = [cap[i] if i in full else left * w[i] / share for i in range(len(sizes))]
        new = {i for i in range(len(sizes)) if i not in full and out[i] > cap[i]}
        if not new:
            return out
        full |= new


def taken(rows):
    """(id, text, source) rows -> id -> (size, source_size, target, taken); ids are unique."""
    size = {i: len(WORD.findall(t or "")) for i, t, _ in rows}
    by = {}
    for i, _, s in rows:
        by.setdefault((s is None, s or ""), []).append(i)
    names = sorted(by)
    text = {i: t or "" for i, t, _ in rows}

    def key(i):
        u = (int(hashlib.md5(f"mix:{i}:{text[i]}".encode()).hexdigest()[:12], 16) + 0.5) / 16**12
        n = size[i]
        w = 0.01 if not n else max(0.01, (n / (n + 20)) / (1 + abs(len(text[i]) / n - 6) / 6))
        return -math.log(u) / w, i, n

    out = {}
    for name, target in zip(names, targets([sum(size[i] for i in by[n]) for n in names]), strict=True):
        total = sum(size[i] for i in by[name])
        whole = int(target // total) if total else 0
        rest = target - whole * total
        for i in sorted(by[name], key=key):
            more = max(0, min(size[i], math.floor(rest)))
            out[i] = (size[i], total, target, whole * size[i] + more)
            rest -= size[i]
    return out

"""Plain-Python versions of the operators, written from their contracts."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

BLANKS = " \t\n\x0b\x0c\r"


def low(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text: str | None, width: int = 5) -> set[tuple]:
    w = words(low(text or ""))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def components(docs: list[tuple[int, str | None]], percent: int = 80) -> dict[int, tuple[int, int]]:
    """doc_id to (n_shingles, component_id)."""
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                k = len(x & y)
                if 100 * k >= percent * (len(x) + len(y) - k):
                    p, q = sorted((find(a), find(b)))
                    root[q] = p
    return {d: (len(sets[d]), find(d)) for d in ids}


def dedup_lines(docs, min_docs=5, min_chars=40):
    """doc_id to (n_lines, n_dropped, kept text)."""
    holders = defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            k = low(line.strip(BLANKS))
            if len(k) >= min_chars:
                holders[k].add(d)
    keeper = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    out = {}
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if keeper.get(low(x.strip(BLANKS)), d) == d]
        out[d] = len(lines), len(lines) - len(kept), "\n".join(kept)
    return out


def signals(text):
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = {x for x in windows if windows.count(x) > 1} if len(windows) < 400 else None
    if often is None:
        counts = defaultdict(int)
        for x in windows:
            counts[x] += 1
        often = {x for x, n in counts.items() if n > 1}
    covered = {i + k for i, x in enumerate(windows) if x in often for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def common_lines(docs, max_docs, min_docs=5, share=10):
    """{(host, line): the document that keeps it}, of rows (doc_id, source, text)."""
    holders, hosts = defaultdict(set), defaultdict(set)
    for d, host, t in docs:
        hosts[host or ""].add(d)
        for line in (t or "").split("\n"):
            if words(line):
                holders[host or "", low(line.strip(BLANKS))].add(d)
    above = lambda n, host: n > max_docs or n >= min_docs and 100 * n > share * len(hosts[host])
    return {k: min(ids) for k, ids in holders.items() if above(len(ids), k[0])}


def judge(docs, max_docs, min_left=30):
    """Rows of (doc_id, source, text) to doc_id: (signals, n_removed, base_failed, kept)."""
    keeper = common_lines(docs, max_docs)
    out = {}
    for d, host, t in docs:
        s = signals(t)
        lines = [x for x in (t or "").split("\n") if words(x)]
        gone = sum(len(words(x)) for x in lines if keeper.get((host or "", low(x.strip(BLANKS))), d) != d)
        failed = s[0] < 50 or 100 * s[4] > 50 * s[0]
        out[d] = s, gone, failed, not failed and 100 * (s[0] - gone) >= min_left * s[0]
    return out


def cleaned(docs, max_docs):
    """Rows of (doc_id, source, text) to doc_id: the text without its host's common lines."""
    keeper = common_lines(docs, max_docs)

    def stays(d, host, line):
        return not words(line) or keeper.get((host or "", low(line.strip(BLANKS))), d) == d

    return {d: t and "\n".join(x for x in t.split("\n") if stays(d, host, x)) for d, host, t in docs}


def md5(data: bytes) -> str:
    return hashlib.md5(data).hexdigest()


def latin_runs(text: str) -> list[str]:
    return re.findall("[A-Za-z\u00c0-\u00ff]+", text)


class Languages:
    """Words by log frequency; unseen ones by their longest known n-grams."""

    def __init__(self, rows):
        """``rows`` of (lang, text)."""
        words = defaultdict(Counter)
        for lang, text in rows:
            words[lang].update(self.words(text))
        grams = {lang: Counter(g for w in seen for n in (5, 4, 3, 2, 1) for g in self.grams(w, n)) for lang, seen in words.items()}
        self.names = sorted(words)
        self.logs = [self.table(words), self.table(grams)]

    @staticmethod
    def words(text):
        return re.findall(r"[^\W\d_]+", text.lower())

    @staticmethod
    def grams(word, n):
        word = f"<{word}>"
        return [word[i : i + n] for i in range(len(word) - n + 1)]

    def table(self, counts):
        entries = set().union(*counts.values()) if counts else set()
        total = {x: counts[x].total() + len(entries) / 2 for x in self.names}
        return {e: [math.log((counts[x][e] + 0.5) / total[x]) for x in self.names] for e in entries}

    def of_word(self, word):
        words, grams = self.logs
        if word in words:
            return words[word]
        for n in (5, 4, 3, 2, 1):
            found = [grams[g] for g in self.grams(word, n) if g in grams]
            if found:
                return [sum(x) / len(found) for x in zip(*found)]
        return [0.0] * len(self.names)

    def predict(self, text):
        """(language, score)"""
        words = self.words(text or "")
        if not self.names or not any(c.isalpha() for w in words for c in w):
            return "und", 0.0
        logs = [sum(x) * min(1.0, 20 / len(words)) for x in zip(*map(self.of_word, words))]
        best = max(range(len(logs)), key=lambda i: (logs[i], -i))
        return self.names[best], 1 / sum(math.exp(x - logs[best]) for x in logs)

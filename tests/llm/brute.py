"""Plain versions of the text operators, row by row, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

from strucsift.llm import language, quality


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def split_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    words = split_words(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def near_groups(texts: dict) -> dict:
    """doc_id -> (n_shingles, component_id) for {doc_id: text}."""
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in holders[x] if j > i).items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def base_counts(text):
    text = text or ""
    words = split_words(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if split_words(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def gram_bucket(gram: bytes) -> int:
    code = int.from_bytes(gram, "little") * 0x9E3779B1 % 2**32
    code ^= code >> 15
    return code * 0x85EBCA77 % 2**32 * quality.BUCKETS >> 32


def gram_ratios(texts, trusted):
    """The length-normalised log ratio of every text; ``trusted`` flags target texts."""
    grams = [[gram_bucket(b[i:i + 4]) for i in range(len(b) - 3)] for b in ((t or "").encode() for t in texts)]
    raw, target = Counter(), Counter()
    for own, flag in zip(grams, trusted, strict=True):
        raw.update(own)
        if flag:
            target.update(own)
    n_raw, n_target = raw.total() + 0.5 * quality.BUCKETS, target.total() + 0.5 * quality.BUCKETS
    if not target:
        return [0.0] * len(grams)
    value = {g: math.log((target[g] + 0.5) / n_target) - math.log((raw[g] + 0.5) / n_raw) for g in raw}
    return [sum(value[g] for g in own) / max(1, len(own)) for own in grams]


def quality_kept(texts, trusted):
    out = []
    for text, ratio in zip(texts, gram_ratios(texts, trusted), strict=True):
        n, _, _, _, repeated = base_counts(text)
        out.append(not (n < 10 or 100 * repeated > 20 * n) and ratio >= quality.THRESHOLD)
    return out


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def contamination(text, benchmark):
    """The contract's columns for one text; ``benchmark`` holds (item_id, text)."""
    words, hit, items = bench_words(text), set(), set()
    for item, own in benchmark:
        test = bench_words(own)
        if not test or item is None:
            continue
        k = min(13, len(test))
        grams = {tuple(test[i:i + k]) for i in range(len(test) - k + 1)}
        for i in range(len(words) - k + 1):
            if tuple(words[i:i + k]) in grams:
                hit.update(range(i, i + k))
                items.add(str(item))
    digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return len(words), len(hit), len(items), digest, bool(hit) and 20 * len(hit) >= len(words)


def drop_passages(texts, least, chars, share):
    """{doc_id: text} without all copies of long shared lines but the one in the least document that stays."""
    trim = lambda x: x.strip(" \t\n\x0b\x0c\r")
    own = {i: [trim(x) for x in (t or "").split("\n")] for i, t in texts.items()}
    holders = defaultdict(set)
    for i, every in own.items():
        for x in every:
            if x:
                holders[x].add(i)
    common = {x for x, h in holders.items() if len(h) >= least}
    groups = near_groups(texts)
    keeper = {x: min(holders[x], key=lambda i: (groups[i][1] != i, i)) for x in common if len(x) > chars}
    out = {}
    for i, text in texts.items():
        if text is None:
            out[i] = None
            continue
        most = sum(len(x) for x in own[i])
        partly = share[1] * sum(len(x) for x in own[i] if x in common) <= share[0] * most
        gone = {x for x in own[i] if x in keeper and keeper[x] != i} if partly else set()
        out[i] = "\n".join(x for x in text.split("\n") if trim(x) not in gone)
    return out


def drop_lines(rows, ratio, least):
    """rows: (key, host, text) -> {key: (text, n_lines, n_dropped)}."""
    trim = lambda x: x.strip(" \t\n\x0b\x0c\r")
    pages, seen = Counter(), Counter()
    for _, host, text in rows:
        pages[host] += 1
        seen.update((host, x) for x in {trim(x) for x in (text or "").split("\n")} if x)
    out = {}
    for key, host, text in rows:
        if text is None:
            out[key] = None, 0, 0
            continue
        every = text.split("\n")
        bad = lambda x: host is not None and seen[host, x] >= least and seen[host, x] > ratio * pages[host]
        kept = [x for x in every if not trim(x) or not bad(trim(x))]
        out[key] = "\n".join(kept), sum(bool(trim(x)) for x in every), len(every) - len(kept)
    return out


def language_grams(text):
    """Counts of (size, bucket) of all byte n-grams of a text, letters in lower case, other signs as spaces."""
    plain = bytes(b + 32 if 0x41 <= b < 0x5B else b if 0x61 <= b < 0x7B or b >= 0x80 else 0x20 for b in (text or "").encode())
    found = Counter()
    for n in language.SIZES:
        for gram, times in Counter(plain[i:i + n] for i in range(len(plain) - n + 1)).items():
            code = int.from_bytes(gram, "little") * 0x9E3779B1 % 2**32
            code ^= code >> 15
            found[n, code * 0x85EBCA77 % 2**32 * language.BUCKETS >> 32] += times
    return found


def languages(training, texts):
    """(language, score) of every text, learned from ``training`` (text, lang)."""
    counts = defaultdict(Counter)
    own = [(language_grams(text), lang) for text, lang in training if lang is not None]
    for grams, lang in own:
        counts[lang].update(grams)
    names = sorted(counts)
    code = language.codewords(len(names)).tolist()
    bits = range(len(code[0]))
    totals = {x: counts[x].total() + 0.5 for x in names}
    known = {}

    def weights(gram):
        if gram not in known:
            share = [(counts[x][gram] + 0.5) / totals[x] for x in names]
            sides = [[[s for s, word in zip(share, code, strict=True) if word[j] * side > 0] for side in (1, -1)] for j in bits]
            known[gram] = [math.log(sum(a) / len(a)) - math.log(sum(b) / len(b)) for a, b in sides]
        return known[gram]

    def margins(grams):
        n = math.sqrt(max(1, grams.total()))
        sums = [0.0 for _ in bits]
        for gram, times in grams.items():
            for j, w in enumerate(weights(gram)):
                sums[j] += times * w
        return [max(-30.0, min(30.0, s / n)) for s in sums]

    trust = [[0.0 for _ in bits] for _ in names]
    sizes = Counter(lang for _, lang in own)
    for grams, lang in own:
        i = names.index(lang)
        for j, m in enumerate(margins(grams)):
            trust[i][j] += (m * code[i][j] > 0) / sizes[lang]
    trust = [[t / max(sum(row) / len(row), 1e-9) for t in row] for row in trust]
    out = []
    for text in texts:
        if not any(map(str.isalpha, text or "")):
            out.append(("und", 0.0))
            continue
        m = margins(language_grams(text))
        far = [sum(t * math.log1p(math.exp(-x * c)) for t, x, c in zip(row, m, word, strict=True)) for row, word in zip(trust, code, strict=True)]
        least = min(far)
        out.append((names[far.index(least)], 1 / sum(math.exp(least - f) for f in far)))
    return out


def toxic_density(words, weights, exceptions):
    """Weights of all words that begin with an entry and are in no exception, over the root of the words.

    ``weights`` has folded entries, ``exceptions`` lists of folded words.
    """
    free = {j + i for e in exceptions for j in range(len(words) - len(e) + 1) if words[j:j + len(e)] == e for i in range(len(e))}
    total = 0.0
    for i, word in enumerate(words):
        held = [w for stem, w in weights.items() if word.startswith(stem)]
        if held and i not in free:
            total += max(held)
    return total / math.sqrt(max(1, len(words)))

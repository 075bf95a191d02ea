"""Plain versions of the text operators, one document at a time, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(text or "")


def repeated(found):
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    times = Counter(windows)
    return len({j for i, w in enumerate(windows) if times[w] > 1 for j in (i, i + 1, i + 2)})


def quality_counts(text):
    text = text or ""
    found, seen, dup = words(text), set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    n_repeat = repeated(found)
    failed = len(found) < 50 or 100 * n_repeat > 50 * len(found)
    return (
        len(found),
        sum(map(len, found)),
        sum(c in "#*$%&|<>" for c in text),
        dup,
        n_repeat,
        failed,
    )


def char_histogram(text):
    counts = [0] * 7
    for c in text or "":
        if "a" <= c <= "z":
            counts[0] += 1
        elif "A" <= c <= "Z":
            counts[1] += 1
        elif "0" <= c <= "9":
            counts[2] += 1
        elif c in " \t\n\x0b\x0c\r":
            counts[3] += 1
        elif c in ".,;:!?'\"()-":
            counts[4] += 1
        elif ord(c) < 128:
            counts[5] += 1
        else:
            counts[6] += 1
    return counts


def word_histogram(text, listed):
    common = list(dict.fromkeys(listed.split())) if listed else []
    counts = [0] * 31
    if not listed:
        return counts
    for w in words(text):
        bare = w[:-1] if len(w) > 1 and w[-1] in ".,;:!?" else w
        bare = bare if bare in common else bare[0].lower() + bare[1:] if bare and bare[0].lower() + bare[1:] in common else None
        counts[common.index(bare) if bare is not None else 30] += 1
    return counts


def js(p, q):
    a, b = sum(p), sum(q)
    if not a or not b:
        return None
    total = 0.0
    for x, y in zip(p, q):
        x, y = x / a, y / b
        total += (x * math.log2(2 * x / (x + y)) if x else 0) + (y * math.log2(2 * y / (x + y)) if y else 0)
    return math.sqrt(max(total / 2, 0))


def quality(docs, common, wide, limits):
    """[kept] of (doc_id, text, lang, ...) rows; ``wide`` and ``limits``: (chars, words)."""
    chosen = [True] * len(docs)
    for char_limit, word_limit in (wide, limits):
        chars, said, total = {}, {}, Counter()
        for (_, text, lang, *_), use in zip(docs, chosen):
            if use:
                chars[lang] = [x + y for x, y in zip(chars.get(lang, [0] * 7), char_histogram(text))]
                said[lang] = [x + y for x, y in zip(said.get(lang, [0] * 31), word_histogram(text, common.get(lang)))]
                total[lang] += len(words(text))
        chosen = []
        for _, text, lang, *_ in docs:
            n, *_, failed = quality_counts(text)
            own = char_histogram(text)
            far = False
            if total[lang] >= 1000:
                if sum(own) >= 200:
                    far |= js(own, chars[lang]) > char_limit
                if n >= 100:
                    d = js(word_histogram(text, common.get(lang)), said[lang])
                    far |= d is not None and d > (word_limit**2 + 30 / (8 * n * math.log(2))) ** 0.5
            chosen.append(not failed and not far)
    return chosen


def frequent_lines(docs, ratio=0.1, least=5, near_once=False):
    """Cleaned texts of (doc_id, text, lang, source, ...) rows, with the lines counted and dropped."""
    white = " \t\r\x0b\x0c"
    total, pages, said = Counter(), Counter(), {}
    group = near_groups([d[:2] for d in docs]) if near_once else range(len(docs))
    for (_, text, _, source, *_), page in zip(docs, group):
        said.setdefault((source, page), set()).update({x.strip(white) for x in (text or "").split("\n")} - {""})
    for (source, _), lines in said.items():
        total[source] += 1
        for line in lines:
            pages[source, line] += 1
    out = []
    for _, text, _, source, *_ in docs:
        if text is None:
            out.append((None, 0, 0))
            continue
        lines = text.split("\n")
        bad = [
            line.strip(white) != "" and pages[source, line.strip(white)] > total[source] * ratio and pages[source, line.strip(white)] >= least
            for line in lines
        ]
        out.append(("\n".join(x for x, b in zip(lines, bad) if not b), sum(x.strip(white) != "" for x in lines), sum(bad)))
    return out


def grams(text, n=5):
    found = words(text)
    size = min(n, len(found))
    return {(size, *found[i : i + size]) for i in range(len(found) - size + 1)} if found else set()


def near_groups(rows, threshold=0.8):
    """A number of the class of each (doc_id, text) row."""
    return near_classes(rows, threshold, numbered=True)


def near_classes(rows, threshold=0.8, numbered=False):
    """[(class_id, n_links)] of (doc_id, text) rows, comparing all pairs that share a gram."""
    sets = [grams(text) for _, text in rows]
    where = {}
    for i, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(i)
    links = [0] * len(rows)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in where[g] if j > i)
        for j, n in shared.items():
            if n >= threshold * (len(s) + len(sets[j]) - n) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    if numbered:
        return [find(i) for i in range(len(rows))]
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            root = find(i)
            least[root] = min(least.get(root, doc), doc)
    return [(least.get(find(i)), links[i]) for i in range(len(rows))]


def folded(text):
    return FOLDED.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def contamination(text, items, window=10):
    """(n_words, n_hit, sorted ids) of a text against (item_id, text) rows."""
    found = folded(text)
    places = {}
    hit, ids = set(), set()
    for item, said in items:
        own = folded(said)
        n = min(window, len(own))
        if not n:
            continue
        if n not in places:
            places[n] = {}
            for i in range(len(found) - n + 1):
                places[n].setdefault(tuple(found[i : i + n]), []).append(i)
        for j in range(len(own) - n + 1):
            for i in places[n].get(tuple(own[j : j + n]), ()):
                hit.update(range(i, i + n))
                ids.add(str(item))
    return len(found), len(hit), sorted(ids)


def slope(sizes, left):
    """c for which the chances min(1, c * size) times the sizes add up to ``left`` words."""
    counts = Counter(n for n in sizes if n)
    for size in sorted(counts, reverse=True):
        c = (left - float(sum(n * k for n, k in counts.items() if n > size))) / float(sum(n * n * k for n, k in counts.items() if n <= size))
        if c * size <= 1:
            return c
    return 0.0


def mixture(rows, weights=(3, 1, 2), share=1.5, most=2.0, seed="mixture-1"):
    """[(size, source_size, target, taken)] of (doc_id, text, source) rows, alike rows in any order."""
    sizes = [len(words(text)) for _, text, _ in rows]
    total = Counter()
    for (_, _, source), n in zip(rows, sizes):
        total[source] += n
    order = sorted((s for s in total if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in total if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    goal, stopped = share * sum(sizes), set()
    while True:
        free = [s for s in order if s not in stopped]
        if not free:
            break
        level = (goal - sum(most * total[s] for s in stopped)) / sum(weight[s] for s in free)
        over = {s for s in free if most * total[s] < level * weight[s]}
        if not over:
            break
        stopped |= over
    target = {s: most * total[s] if s in stopped else level * weight[s] for s in order}
    taken = [0] * len(rows)
    for s in order:
        own = [i for i, r in enumerate(rows) if r[2] == s]
        if not total[s]:
            continue
        ratio = target[s] / total[s]
        whole = math.floor(ratio)
        for i in own:
            taken[i] = whole * sizes[i]
        left = target[s] - whole * total[s]
        if left <= 0:
            continue
        c = slope([sizes[i] for i in own], left)

        def key(i):
            doc, text, _ = rows[i]
            name = "" if doc is None else str(doc)
            h = hashlib.md5((text or "").encode()).hexdigest()
            u = (int(hashlib.md5(f"{seed}:{name}:{h}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            p = c * sizes[i]
            if p >= 1:
                return 0.0, name, h
            q = (u / (1 - u)) / (p / (1 - p)) if p > 0 else None
            return 1.0 if q is None else q / (1 + q), name, h

        ranked, used, rest = sorted(own, key=key), 0, []
        for i in ranked:
            if not rest and used + sizes[i] <= left:
                used += sizes[i]
                taken[i] += sizes[i]
            else:
                rest.append(i)
        if rest:
            best = min(rest, key=lambda i: (abs(sizes[i] - (left - used)), key(i)))
            if abs(sizes[best] - (left - used)) < left - used:
                taken[best] += sizes[best]
    return [(n, total[r[2]], target[r[2]], t) for r, n, t in zip(rows, sizes, taken)]


def page_template(pages):
    """(nodes and texts to leave out, content beside articles) of one host's pages, straight from the definitions."""
    from tally.llm import html_main as h

    looks, texts, on, marks, below = {}, {}, {}, {}, {}
    for number, page in enumerate(pages):
        blocks, nodes = h.parse(page, tree=True)
        for node, children in nodes:
            looks.setdefault(node.ident, []).append(children)
            on.setdefault(node.ident, set()).add(number)
            marks[node.ident] = (node.named, node.inside != "")
        for block in blocks:
            texts.setdefault((block.owner.ident, block.text), []).append(number)
            node = block.owner
            while node is not None:
                below.setdefault(node.ident, set()).add((block.owner.ident, block.text))
                node = node.above

    def entropy(values, base):
        shares = [values.count(v) / len(values) for v in set(values)]
        return min(-sum(p * math.log(p) for p in shares) / math.log(base), 1)

    worth = {t: 1 - entropy(seen, len(on[t[0]])) for t, seen in texts.items()}
    out, content = set(), set()
    if sum(worth.values()) / len(worth) < h.VARIED_HOST:
        return frozenset(), frozenset()
    for node, branch in below.items():
        if node == h.ROOT or len(on[node]) < h.LEAST_PAGES:
            continue
        value = sum(worth[t] for t in branch) / len(branch)
        named, inside = marks[node]
        most = len(on[node]) >= h.HOST_SHARE * len(pages)
        low = max(value, entropy(looks[node], len(on[node]))) < h.LEAST_IMPORTANCE
        if low and (named or most or not inside):
            out.add(node)
        elif not low and not inside and value >= h.VARIED_NODE:
            content.add(node)
    for (node, text), seen in texts.items():
        n = len(on[node])
        if n >= max(h.LEAST_PAGES, h.HOST_SHARE * len(pages)) and len(set(seen)) >= h.TEXT_SHARE * n and worth[node, text] < h.LEAST_IMPORTANCE:
            out.add(h._text_ident(node, text))
    return frozenset(out), frozenset(content)

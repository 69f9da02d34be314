"""Plain versions of the operators, row by row, and tables with odd rows."""

import math
import random
import re
from collections import ChainMap, Counter, defaultdict

from pyspark.sql import functions as F

SCHEMA = (
    "doc_id long, text string, lang string, row long, doc string, name string, n long, kept string,"
    " part int, place string, node string, hash string, begin string, ids string, `__row` string"
)
SPACE = " \t\n\x0b\x0c\r"


def table(spark, rows):
    """Documents (doc_id, text, lang) with further columns whose names operators use."""
    extra = ("x",) * 0
    full = [(*r, None, "d", "n", 1, "k", 1, "p", "o", "h", "b", "i", "r", *extra) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3, F.xxhash64("text"))


def word_list(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def syllables(rng, n, size=40):
    parts = ["on", "the", "er", "st", "in", "é", "wh", "ñ", "at", "ou", "ly", "Ö"][: max(2, size)]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


def odd_rows(rng):
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = syllables(rng, 4000)
    some = syllables(rng, 60)
    return [
        (1, None, "en"), (2, "", "en"), (3, " \t\n", None), (4, "a", "fr"), (5, "a  b", "fr"),
        (6, "a\t\nb", "fr"), (7, long, "en"), (8, long + " x", "en"), (9, long, None),
        (10, some, "en"), (10, some, "en"), (10, some + " y", "en"), (None, some, "en"),
        (None, None, None), (11, "x" * 30_000, "de"), (12, "\x00   😀 é", "en"),
    ]


def components(pairs, nodes):
    root = {x: x for x in nodes}

    def top(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {x: top(x) for x in nodes}


def grams(text, n):
    words = word_list(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < n:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(*(words[i:] for i in range(n)), strict=False))


def linked(sets, share):
    """Pairs of indices of sets that share at least `share` percent of their union."""
    lists = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            lists[g].append(i)
    for i, s in enumerate(sets):
        both = Counter(j for g in s for j in lists[g] if j > i)
        for j, k in both.items():
            if 100 * k >= share * (len(s) + len(sets[j]) - k):
                yield i, j


def base_figures(text):
    text = text or ""
    words = word_list(text)
    seen, lines = set(), 0
    for line in text.split("\n"):
        if word_list(line):
            lines += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            repeated |= set(range(i, i + 5))
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, lines, len(repeated)


class KneserNey:
    """Interpolated modified Kneser-Ney over characters, from dictionaries of tuples."""

    def __init__(self, texts, order):
        self.order = order
        counts = Counter(g for t in texts for g in self.grams(t))
        self.levels = {order: counts}
        for k in range(order - 1, 0, -1):
            self.levels[k] = Counter(g[1:] for g in self.levels[k + 1])
        self.symbols = len(self.levels[1])
        self.cuts, self.total, self.classes = {}, defaultdict(int), defaultdict(Counter)
        for k, level in self.levels.items():
            n = Counter(level.values())
            share = max(n[1], 1) / (max(n[1], 1) + 2 * n[2])
            cut = [min(max(i - (i + 1) * share * n[i + 1] / max(n[i], 1), 0.1), i - 0.1) for i in (1, 2, 3)]
            self.cuts[k] = cut
            for g, c in level.items():
                self.total[k, g[:-1]] += c
                self.classes[k, g[:-1]][min(c, 3)] += 1

    def grams(self, text):
        padded = (0,) * (self.order - 1) + tuple(self.symbol(c) for c in text)
        return [padded[i : i + self.order] for i in range(len(text))]

    @staticmethod
    def symbol(c):
        c = ord(c)
        return max(c, 1) if c < 2048 else 2048 + (c * 0x9E3779B1 >> 11 & 2047)

    def p(self, gram):
        k = len(gram)
        if not k:
            return 1 / (self.symbols + 1)
        c, total = self.levels[k][gram], self.total[k, gram[:-1]]
        if not total:
            return self.p(gram[1:])
        cut = self.cuts[k]
        kinds = self.classes[k, gram[:-1]]
        weight = sum(cut[i - 1] * kinds[i] for i in (1, 2, 3)) / total
        own = c - cut[min(c, 3) - 1] if c else 0
        return own / total + weight * self.p(gram[1:])

    def without(self, text):
        """This model without what `text` brought to its counts, with the same discounts."""
        out = KneserNey.__new__(KneserNey)
        out.order, out.cuts, out.levels = self.order, self.cuts, {}
        total, classes, less = {}, {}, Counter(self.grams(text))
        for k in range(self.order, 0, -1):
            level = {}
            for g, n in less.items():
                before = self.levels[k][g]
                level[g] = after = before - n
                context = (k, g[:-1])
                total[context] = total.get(context, self.total[context]) - n
                kinds = classes.setdefault(context, Counter(self.classes[context]))
                kinds[min(before, 3)] -= 1
                kinds[min(after, 3)] += after > 0
            out.levels[k] = ChainMap(level, self.levels[k])
            less = Counter(g[1:] for g in less if not level[g])
        out.total, out.classes = ChainMap(total, self.total), ChainMap(classes, self.classes)
        out.symbols = sum(n > 0 for n in out.levels[1].values())
        return out

    def nats(self, text):
        return -sum(math.log(self.p(g)) for g in self.grams(text)) / max(1, len(text))


def median(values):
    values = sorted(values)
    n = len(values)
    return (values[(n - 1) // 2] + values[n // 2]) / 2


def verdicts(rows, order, below, above, least, more):
    """(figures, base_failed, nats, kept) of each (text, lang), with equal texts once in
    models and medians, and each text scored without what it brought."""
    full, scored = {}, {}
    for lang in {lang for _, lang in rows}:
        texts = dict.fromkeys(t for t, of in rows if of == lang)
        full[lang] = KneserNey(texts, order)
        for t in texts:
            figures = base_figures(t)
            failed = figures[0] < 10 or 100 * figures[4] > 20 * figures[0]
            model = full[lang].without(t)
            nats = model.nats(t) if model.symbols else 0.0
            scored[t, lang] = [figures, failed, nats, False]
        mine = [(t, x) for (t, of), x in scored.items() if of == lang]
        sound = [(t, x) for t, x in mine if not x[1]]
        if not sound:
            continue
        middle = median([round(x[2], 3) for _, x in sound])
        apart = [round(abs(x[2] - middle) * len(t) ** 0.5, 2) for t, x in sound]
        spread = max(1.4826 * median(apart), least)
        for t, x in mine:
            reach = spread / max(1, len(t)) ** 0.5
            within = middle - below * reach - more <= x[2] <= middle + above * reach + more
            x[3] = within and not x[1]
    return [scored[r] for r in rows]


def random_texts(seed, n=120):
    """Texts of some words, many of them changed copies of others."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        if out and rng.random() < 0.6:
            words = rng.choice(out).split(" ")
            for _ in range(rng.randint(0, 3)):
                i = rng.randrange(len(words) + 1)
                words[i : i + rng.randint(0, 1)] = [syllables(rng, 1)] * rng.randint(0, 1)
            out.append(" ".join(words))
        else:
            out.append(syllables(rng, rng.choice([1, 3, 8, 12, 30, 60, 150])))
    return out

"""The ranking model over Python dicts, for small inputs."""

import math
import re
from collections import Counter

from lodestone.functions.patterns import SIMPLE_TOKEN
from lodestone.functions.stemmer import porter_stem
from lodestone.functions.words import STOPWORDS


def tokens(text, stemmed=False):
    kept = [t for t in re.findall(SIMPLE_TOKEN, text.lower()) if t not in STOPWORDS]
    return [porter_stem(t) for t in kept] if stemmed else kept


class Model:
    def __init__(self, docs, min_df=0, stemmed=False):
        self.stemmed = stemmed
        self.tf = {d: c for d, t in docs if (c := Counter(tokens(t, stemmed)))}
        self.length = {d: sum(c.values()) for d, c in self.tf.items()}
        self.n = len(self.tf)
        self.avg = sum(self.length.values()) / self.n
        df = Counter(t for c in self.tf.values() for t in c)
        self.df = {t: n for t, n in df.items() if n > min_df}

    def weight(self, d, t):
        return self.tf[d][t] / self.length[d] * math.log10(self.n / self.df[t])

    def norm(self, d):
        return math.sqrt(sum(self.weight(d, t) ** 2 for t in self.tf[d] if t in self.df))

    def _matches(self, queries):
        for q, text in queries:
            asked = Counter(tokens(text, self.stemmed))
            for d in self.tf:
                both = [t for t in asked if t in self.df and t in self.tf[d]]
                if both:
                    yield q, d, asked, both

    def bm25(self, queries, k1=1.5, b=0.75):
        def term(d, t):
            idf = math.log(1 + (self.n - self.df[t] + 0.5) / (self.df[t] + 0.5))
            tf = self.tf[d][t]
            return idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * self.length[d] / self.avg))

        return {(q, d): sum(term(d, t) for t in both) for q, d, _, both in self._matches(queries)}

    def cosine(self, queries):
        out = {}
        for q, d, asked, both in self._matches(queries):
            total = sum(asked.values())
            vec = {t: n / total * math.log10(self.n / (self.df[t] + 1e-7)) for t, n in asked.items() if t in self.df}
            length = math.sqrt(sum(w * w for w in vec.values())) * self.norm(d)
            dot = sum(self.weight(d, t) * vec[t] for t in both)
            out[q, d] = dot / length if length else 0.0
        return out

    def counts(self, queries):
        return {(q, d): len(both) for q, d, _, both in self._matches(queries)}

"""The definitions spelled out in plain Python, for small fixtures."""

from __future__ import annotations

import math
from collections import defaultdict

PUNCTUATION = set("{}()[];,.:=+-*/%&|^!~<>?@")


class Model:
    def __init__(self, methods, n, k=0.01, lam=0.4):
        self.n, self.k, self.lam = n, k, lam
        self.words = {"<START>", "<END>"}.union(*methods)
        self.after = defaultdict(dict)
        for padded in (self.pad(m) for m in methods):
            for i in range(len(padded) - n + 1):
                for m in range(n):
                    counts = self.after[tuple(padded[i : i + m])]
                    counts[padded[i + m]] = counts.get(padded[i + m], 0) + 1

    def pad(self, tokens):
        return ["<START>"] * (self.n - 1) + list(tokens) + ["<END>"]

    def raw(self, context, token):
        counts = self.after.get(tuple(context))
        if counts is None:
            return 0.0
        return (counts.get(token, 0) + self.k) / (sum(counts.values()) + self.k * len(self.words))

    def p(self, context, token):
        result = self.raw((), token)
        for m in range(1, len(context) + 1):
            suffix = tuple(context[len(context) - m :])
            if suffix in self.after:
                weight = self.lam + (1 - self.lam) * min(1.0, sum(self.after[suffix].values()) / 10)
                result = weight * self.raw(suffix, token) + (1 - weight) * result
        return result

    def best(self, context):
        counts = self.after.get(tuple(context))
        return None if counts is None else max(counts, key=lambda t: counts[t])

    def predict(self, context):
        known = [m for m in range(len(context) + 1) if tuple(context[len(context) - m :]) in self.after]
        suffix = tuple(context[len(context) - max(known) :])
        return max(known), self.best(suffix), self.p(suffix, self.best(suffix))

    def positions(self, tokens):
        padded = self.pad(tokens)
        for i in range(len(tokens) + 1):
            yield i, tuple(padded[i : i + self.n - 1]), padded[i + self.n - 1]

    def metrics(self, methods):
        scored = [(c, t) for tokens in methods for _, c, t in self.positions(tokens)]
        wordy = [(c, t) for c, t in scored if t not in PUNCTUATION]

        def perplexity(pairs):
            if not pairs:
                return math.inf
            return 2 ** (-sum(math.log2(self.p(c, t)) for c, t in pairs) / len(pairs))

        hits = sum(self.best(c) == t for c, t in scored)
        return {
            "accuracy": hits / len(scored) if scored else 0.0,
            "perplexity": perplexity(scored),
            "perplexity_no_punctuation": perplexity(wordy),
            "vocabulary_size": len(self.words),
        }

"""Small deterministic models, for queries and tests."""

from __future__ import annotations

import json

CATEGORIES = (
    "format_compliance",
    "helpfulness",
    "correctness",
    "reasoning_quality",
    "style_clarity",
    "safety",
)


def generator():
    """Echoes the prompt after a think block that holds its length."""

    def complete(prompts: list) -> list:
        return [f"<think>{len(p)}</think>\nRe: {p}" for p in prompts]

    return complete


def judge():
    """Scores by the length of the question; the reply has text around its JSON."""

    def reply(requests: list) -> list:
        replies = []
        for messages in requests:
            size = len(messages[-1]["content"])
            scores = {key: (size + i * 5) % 9 - 1 for i, key in enumerate(CATEGORIES)}
            body = {"scores": scores, "reasons": {"helpfulness": f" size {size} "}}
            replies.append(f"Here it is: {json.dumps(body)}")
        return replies

    return reply


def scorer():
    """Two outputs per conversation; the last one is the score."""

    def score(conversations: list) -> list:
        sizes = [[len(m["content"]) for m in messages] for messages in conversations]
        return [[0.0, (asked + 0.5 * given) % 97] for asked, given in sizes]

    return score


def length_scores(prompts, completions, **columns):
    """A reward over lists that looks at lengths."""
    return [len(c) % 13 + 0.25 * (len(p) % 7) for p, c in zip(prompts, completions)]


class KeyScores:
    """A reward over lists that keeps something from call to call and reads a metadata column."""

    def __init__(self, points):
        self.points = points

    def __call__(self, prompts, completions, answer_key, turn, **columns):
        return [self.points.get(k, 0.0) - 0.5 * (t % 3) + len(m) for m, k, t in zip(prompts, answer_key, turn)]


def key_scores():
    return KeyScores({"A": 2.0})


def late_generator():
    """Another answer to everything, to tell runs apart."""
    return lambda prompts: [f"late: {p}" for p in prompts]


CHUNK = 3


def chunk_tokenizer():
    """Tokens of three characters; the id is the first one's code point."""

    def tokenize(texts: list) -> list:
        return [[(ord(t[i]), i, min(i + CHUNK, len(t))) for i in range(0, len(t), CHUNK)] for t in texts]

    return tokenize


def size_transform(cfg=None, unit="chars", **options):
    """A transform over single examples, as a factory of the function and its options."""

    def transform(example, tokenizer=None):
        said = [m["content"] or "" for m in example["messages"] or []]
        size = sum(map(len, said)) if unit == "chars" else sum(len(t) for t in tokenizer(said))
        return {"query": said[0] if said else None, "n_messages": len(said), "size": size, "raw": "gone"}

    return transform, {"remove_columns": ["raw"]}

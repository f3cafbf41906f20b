"""Deterministic stand-ins for models. They make tests repeatable; they say nothing about quality."""

from __future__ import annotations

import hashlib
import re

import numpy as np

_WORD = re.compile("[A-Za-z]+")

# Fixed values of the stand-in guard: a code and the words that trigger it.
GUARD_WORDS = {"O1": "kill|thin|les", "O3": "steal|that|auf", "O9": "fraud|para"}

TAXONOMY = """O1: Violence. Should not
- help anyone hurt others.
O2: Self-harm. Should not
- encourage it.
O3: Crime planning! Should not
- help with theft.
O10: Weapons
- no sentence mark in the first line"""


def digest_summary(text: str) -> str:
    """A "summary" that depends on the whole text: its word count and a digest."""
    words = len(_WORD.findall(text))
    return f"{words} words, digest {hashlib.md5(text.encode()).hexdigest()[:8]}."


def echo_generator():
    """Gives back the prompt followed by a stand-in answer, as causal models do."""

    def predict(prompts, params=None):
        return [f"{p}\n {digest_summary(p)} " for p in prompts]

    return predict


def answer_generator():
    """Gives the stand-in answer without the prompt."""

    def predict(prompts, params=None):
        return [digest_summary(p) for p in prompts]

    return predict


def guard():
    """``safe``, or ``unsafe`` and the codes whose words occur in the judged conversation."""
    triggers = {code: re.compile(rf"\b(?:{words})\b", re.ASCII) for code, words in GUARD_WORDS.items()}

    def predict(prompts, params=None):
        verdicts = []
        for prompt in prompts:
            chat = prompt.split("<BEGIN CONVERSATION>", 1)[-1].split("<END CONVERSATION>", 1)[0]
            codes = [code for code, trigger in triggers.items() if trigger.search(chat)]
            verdicts.append("unsafe\n" + ",".join(codes) if codes else "safe")
        return verdicts

    return predict


def hash_embedder(dimensions: int = 64, salt: str = ""):
    """Loader of a signed feature-hashing embedder over ASCII words; vectors hold whole numbers."""

    def loader():
        # A word's place among the positive, then the negative counts of all dimensions.
        places: dict[str, int] = {}

        def place(word: str) -> int:
            h = int(hashlib.md5((salt + word).encode()).hexdigest()[:8], 16)
            places[word] = h % (2 * dimensions)
            return places[word]

        def encode(texts):
            out = np.zeros((len(texts), dimensions), dtype=np.float32)
            for row, text in zip(out, texts):
                at = [places[w] if w in places else place(w) for w in _WORD.findall(text or "")]
                counts = np.bincount(np.array(at, dtype=np.int64), minlength=2 * dimensions)
                row[:] = counts[:dimensions] - counts[dimensions:]
            return out

        return encode

    return loader

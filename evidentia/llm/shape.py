"""Features of how a text is written: pairs of character classes, and a few shares on a scale of steps."""

from __future__ import annotations

from operator import eq

import numpy as np

CLASSES = 64


def _classes() -> np.ndarray:
    """A class for each byte: lower-case letters one each, capitals, digits, spaces and marks apart, all other bytes together."""
    out = np.full(256, CLASSES - 1, np.uint8)
    out[ord("a") : ord("z") + 1] = np.arange(26)
    out[ord("A") : ord("Z") + 1] = 26
    out[ord("0") : ord("9") + 1] = 27
    out[[ord(c) for c in " \n\t\r"]] = [28, 29, 30, 30]
    marks = [i for i in range(33, 127) if not chr(i).isalnum()]
    out[marks] = 31 + np.minimum(np.arange(len(marks)), CLASSES - 33)
    return out


BYTE_CLASS = _classes()
PAIRS = CLASSES * CLASSES

#: Steps of the shares of words equal to the one before, of marks other than ordinary stops, and of capitals.
STEPS = np.array([0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7])
SHARES = 3
STOPS = BYTE_CLASS[[ord(c) for c in ".,"]]


def pairs_and_steps(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the PAIRS pairs of neighbouring bytes' classes, and which steps each share exceeds."""
    c = classes_of(text)
    pairs = np.bincount(c[:-1].astype(np.int64) * CLASSES + c[1:], minlength=PAIRS) if len(c) > 1 else np.zeros(PAIRS, np.int64)
    return pairs, steps_of(c, text.split())


def classes_of(text: str) -> np.ndarray:
    return BYTE_CLASS[np.frombuffer(text.encode(), np.uint8)]


def steps_of(c: np.ndarray, words: list[str]) -> np.ndarray:
    """Which steps each share exceeds, by the classes of a text's bytes and its words."""
    single = np.bincount(c, minlength=CLASSES)
    again = sum(map(eq, words, words[1:])) / max(len(words), 1)
    marks = (single[31 : CLASSES - 1].sum() - single[STOPS].sum()) / max(len(c), 1)
    capitals = single[26] / max(len(c), 1)
    return (np.array([again, marks, capitals])[:, None] > STEPS).reshape(-1)

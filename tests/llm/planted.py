"""Invented texts and digests for the tests."""

import hashlib
import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed: int, n: int, alphabet: str = "abcdefghijklmnopqrstuvwxyz") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(2, 8))) for _ in range(n))


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()

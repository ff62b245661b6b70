"""M1: the preference vector of a profile.

The matcher fits its vectoriser on one document (the profile's skills and
keywords), so every idf is 1 and the vector is the L2-normalised count of the
profile's 1- and 2-grams after stop-word removal.  The profile is driver-side
configuration of bounded size; the vector is computed here and enters the plan
as literals.
"""

from __future__ import annotations

import re
from collections import Counter

from hirelens import config

TOKEN = re.compile(r"(?u)\b\w\w+\b")


def preference_document(profile: dict) -> str:
    must = config.get(profile, "skills", "must_have", default=[])
    nice = config.get(profile, "skills", "nice_to_have", default=[])
    kws = config.get(profile, "keywords", default=[])
    return f"{' '.join(list(must) + list(nice))} {' '.join(kws)}"


def ngrams(tokens: list[str]) -> list[str]:
    return tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]


def preference_vector(profile: dict, stop_words=None, max_features: int = 10000) -> dict[str, float]:
    """Term -> weight (count / L2 norm) of the profile document; {} when no term survives."""
    stop = set(config.STOP_WORDS if stop_words is None else stop_words)
    toks = [t for t in TOKEN.findall(preference_document(profile).lower()) if t not in stop]
    counts = Counter(ngrams(toks))
    if max_features and len(counts) > max_features:
        keep = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:max_features]
        counts = Counter(dict(keep))
    norm = sum(v * v for v in counts.values()) ** 0.5
    return {t: v / norm for t, v in sorted(counts.items())} if norm else {}

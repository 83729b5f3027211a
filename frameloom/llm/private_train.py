"""Training of the models of private.py on pattern-labelled documents.

``python -m frameloom.llm.private_train DIR`` reads at most SAMPLE documents
and the list of names of a test folder, labels the generators' candidates by
the patterns below (some stay unlabelled), fits one model per kind on four
fifths of the documents, sets its threshold on the rest, and writes the model
file. In a third of the training rows what the name list says is blanked, so
that the context is learned too: the list is incomplete.
"""

from __future__ import annotations

import json
import re
import sys

import numpy as np
import pyarrow.parquet as pq

from frameloom.llm import boosting
from frameloom.llm.private import _AT, ID_CUES, KINDS, MODEL, OTHER_CUES, PHONE_CUES, Candidate, Names, _before, _near, candidates

#: Documents of the labelled sample at most.
SAMPLE = 10_000
_STATED = re.compile(r"(?:name is|written by|[Tt]hanks to|[Ww]e asked|[Ss]igned by:|[Rr]eviewer:|[Cc]ontact:|[Cc]redit \(|—)\s*$")
_STATED_AFTER = re.compile(r"\s*(?:lives at|approved the|signed the|, annotator)")


def label(text: str, c: Candidate) -> bool | None:
    """True, false, or None where the patterns don't tell."""
    t, before = text[c.start : c.end], _before(text, c.start)
    if c.kind == "email":
        tail = re.split(r"[\W_]+", t)[-1]
        return tail.isalpha() and len(tail) >= 2 and bool(_AT.search(t))
    if c.kind == "address":
        return not re.search(r"\b[Tt]ake\b", t)
    if c.kind == "person":
        g1, _, f1, _, g2, _, f2, _ = c.x[:8]
        comma = c.x[8]
        if (g1 and f2 and not comma) or (f1 and g2):
            return not c.x[14]
        stated = _STATED.search(text[max(0, c.start - 24) : c.start]) or _STATED_AFTER.match(text[c.end : c.end + 14])
        if stated and not (c.x[12] or c.x[13] or c.x[14]):
            return None
        return False
    phone, ident, other = _near(before, PHONE_CUES), _near(before, ID_CUES), _near(before, OTHER_CUES)
    strict = c.x[21] or c.x[22]  # a part of a longer run of digits
    wordy = re.match(r"(?:ID|NO|NR|AT|ON)\b", t)
    if wordy:
        return False
    best = max(phone, ident, other)
    lettered = bool(c.x[9] or c.x[10])
    if c.kind == "phone":
        if lettered:
            return False
        if t[0] == "+" and other < 0.5:
            return not strict
        if best == 0:
            return None
        return bool(phone == best and phone > ident and not strict and not (other == best))
    if best == 0:
        return None
    front = bool(c.x[21]) and not re.match(r"(?:ID|NO|NR|AT|ON)\b", text[max(0, c.start - 3) : c.start].strip())
    return bool(ident == best and ident > other and not c.x[22] and not front and t[0] not in "+(")


def train(folder: str, out: str = str(MODEL), rows: int = SAMPLE) -> dict[str, float]:
    docs = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).sort_by("doc_id").slice(0, rows).to_pylist()
    parts = pq.read_table(f"{folder}/name_parts.parquet").to_pylist()
    names = Names([(p["name_part"], p["part_kind"]) for p in parts])
    sets: dict[str, list] = {k: [] for k in KINDS}
    for i, d in enumerate(docs):
        for c in candidates(d["text"] or "", names):
            y = label(d["text"], c)
            if y is not None:
                sets[c.kind].append((i % 5 == 0, c.x, y))
    rng, f1, models = np.random.default_rng(7), {}, {}
    for k, rs in sets.items():
        held = np.array([r[0] for r in rs])
        x, y = np.array([r[1] for r in rs], float), np.array([r[2] for r in rs], bool)
        fit_x, fit_y = x[~held].copy(), y[~held]
        if k == "person":
            blind = rng.random(len(fit_x)) < 1 / 3
            fit_x[np.ix_(blind, [0, 2, 4, 6])] = 0
            fit_x[np.ix_(blind & (rng.random(len(fit_x)) < 0.5), [1, 3, 5, 7])] = 0
        neg = np.flatnonzero(~fit_y)
        if len(neg) > 20_000:
            keep = np.sort(np.concatenate([np.flatnonzero(fit_y), rng.choice(neg, 20_000, replace=False)]))
            fit_x, fit_y = fit_x[keep], fit_y[keep]
        m = boosting.fit(fit_x, fit_y)
        f1[k] = boosting.calibrate(m, x[held], y[held])
        models[k] = m.to_dict()
        print(k, "rows", len(rs), "positive", int(y.sum()), "held-out F1", round(f1[k], 4), "threshold", round(m.threshold, 3))
    with open(out, "w") as f:
        json.dump(models, f)
        f.write("\n")
    return f1


if __name__ == "__main__":
    train(sys.argv[1])

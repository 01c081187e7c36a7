"""Invented raw inputs of every kind that the engine reads, for runs from files to
published tables where no real data may be. Nothing derived is written: classes,
keys and counts come from the engine."""

from __future__ import annotations

import csv
import json
import os
import random
from datetime import datetime, timezone

from tallyspan.operators.normalize import STATUS_CLASS, VERDICT_CLASS
from tallyspan.sources.landing import safe_name, shard_of
from tallyspan.sources.readers import METADATA_CSV
from tallyspan.sources.sinks import json_lines_file, write_json

_DAY = 86_400
_START = int(datetime(2018, 1, 1, tzinfo=timezone.utc).timestamp())


def write(root: str, *, seed: int = 7, users: int = 12, problems: int = 10, attempts: int = 30) -> dict[str, int]:
    """Below root: landing/ (a compressed file of JSON lines for each user),
    users.json, problems.jsonl, metadata/ (a CSV file for each problem and their
    index). Returns what was written: attempts (different ones), repeats, rows of
    metadata. The same seed gives the same data."""
    rng = random.Random(seed)
    countries = ["Arland", "Borland", None, ""]
    handles = [("_" if u == 0 else "") + f"user{u}" for u in range(users)]
    listed = [{"handle": h, "rating": rng.randrange(800, 3200), "maxRating": 3300, "country": countries[u % 4], "organization": " Uni  A" if u % 2 else None, "registrationTimeSeconds": _START - rng.randrange(900) * _DAY} for u, h in enumerate(handles)]
    write_json(os.path.join(root, "users.json"), {"status": "OK", "result": listed})

    # The first two problems are one, given in two contests that follow each other.
    own = [{"contestId": 100 + p, "index": "A", "name": "Twin" if p < 2 else f"Problem {p}", "tags": rng.sample(["dp", "math", "greedy"], p % 3)} for p in range(problems)]
    published = [{"problem_id": f"{p['contestId']}A", "problem_rating": 800 + 100 * i, "problem_tags": p["tags"], "solved_count": rng.randrange(500)} for i, p in enumerate(own) if i != 1]
    os.makedirs(root, exist_ok=True)
    with open(os.path.join(root, "problems.jsonl"), "w", encoding="utf-8") as f:
        f.writelines(json.dumps(r) + "\n" for r in published)

    verdicts, n, repeats = [*VERDICT_CLASS, None], 0, 0
    last: dict | None = None
    for u, handle in enumerate(handles):
        rows = []
        if last and u % 4 == 1:  # a team's attempt stands in the files of its members
            rows.append(last)
            repeats += 1
        for _ in range(attempts):
            n += 1
            team = [handle] if rng.random() < 0.9 else [handle, "guest"]
            author = {"members": [{"handle": h} for h in team], "participantType": rng.choice(["CONTESTANT", "PRACTICE"]), "ghost": False}
            p = rng.choice(own)
            rows.append({"id": n, "contestId": p["contestId"], "creationTimeSeconds": _START + rng.randrange(1500) * _DAY, "verdict": rng.choice(verdicts), "author": author, "problem": p, "programmingLanguage": "C"})
        last = rows[-1]
        json_lines_file(rows, os.path.join(root, "landing", shard_of(handle), f"{safe_name(handle)}.jsonl.gz"))

    os.makedirs(os.path.join(root, "metadata"), exist_ok=True)
    columns, statuses, m = [c.split()[0] for c in METADATA_CSV.strip().replace("\n", " ").split(", ")], list(STATUS_CLASS), 0
    for p in range(3):
        with open(os.path.join(root, "metadata", f"p{p:05d}.csv"), "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f)
            out.writerow(columns)
            for i in range(20 * (p < 2)):  # the last file has a header alone
                m += 1
                out.writerow([f"s{p}-{i}", f"p{p:05d}", f"u{i % 5}", _START + rng.randrange(1500) * _DAY, "C", "C", "c", rng.choice(statuses), rng.choice([-1, 10, 20]), 100, 200, rng.choice(["", "3/4"])])
    with open(os.path.join(root, "metadata", "index.csv"), "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(["id", "name", "dataset", "time_limit", "memory_limit", "rating", "tags", "complexity"])
        out.writerows([f"p{p:05d}", f"Problem {p}", "AIZU", 1000, 1000, "", "", ""] for p in range(3))
    return {"attempts": n, "repeats": repeats, "metadata": m, "users": users}

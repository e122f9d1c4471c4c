"""The prefix trie of rebuilt conversations, by Python dicts."""

import hashlib
import math
import zlib
from collections import defaultdict


def rebuild(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(x)] for c, x in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    return out


def brute(rows):
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in rebuild(rows).items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[x] for x in children[node])
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
    for node, ids in members.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        yield min(ids), len(node), parent, len(ids), len(children[node]), leaves[node], saved[node], digest

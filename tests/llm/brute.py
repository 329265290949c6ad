"""Plain versions of the operators, for small tables held in memory."""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

from basketlens.llm import mixing, packing, secrets

SPACE = re.compile(r"[ \t\n\r\f\x0b]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def shingles(text):
    w = words((text or "").lower())
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def jaccard_classes(docs):
    """{doc_id: (class_id, n_links)} for (doc_id, text) pairs of different ids."""
    sets = {d: shingles(t) for d, t in docs}
    links = {d: set() for d in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if shared * 5 >= 4 * (len(sets[a]) + len(sets[b]) - shared):
                    links[a].add(b)
                    links[b].add(a)
    out = {}
    for d in sorted(sets):
        if d in out:
            continue
        todo, seen = [d], {d}
        while todo:
            for x in links[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        out |= {x: (d, len(links[x])) for x in seen}
    return out


def secret_spans(text, rules=secrets.RULES):
    found = []
    for place, r in enumerate(rules):
        for m in re.finditer(r.pattern, text or "", re.ASCII):
            if len(m[r.group]) >= r.least:
                found.append((m.start(), place, r.kind, m.end()))
    return sorted(found)


def redacted(text):
    at, out = 0, []
    for start, _, kind, end in secret_spans(text):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def shared_out(budget, children):
    """{name: grant} from {name: (weight, supply)}, filling children one by one."""
    grants, left = {}, budget
    rest = sorted(children.items(), key=lambda c: (c[1][1] / c[1][0], c[0]))
    while rest:
        name, (weight, supply) = rest[0]
        total = sum(w for _, (w, _) in rest)
        if supply * total > left * weight:
            return grants | {n: left * w // total for n, (w, _) in rest}
        grants[name] = supply
        left -= supply
        rest = rest[1:]
    return grants


def mixed(docs, epochs=mixing.EPOCHS, share=mixing.BUDGET_SHARE, seed=mixing.SEED):
    """Chosen (doc_id, epoch) of rows (doc_id, domain, lang, source, tokens)."""
    leaves = defaultdict(list)
    for d in docs:
        leaves[d[1:4]].append(d)
    tokens = {leaf: sum(d[4] for d in rows) for leaf, rows in leaves.items()}
    budgets = {(): sum(tokens.values()) * share[0] // share[1]}
    for depth, level in enumerate(mixing.LEVELS):
        for parent in [p for p in budgets if len(p) == depth]:
            supply = defaultdict(int)
            for leaf, n in tokens.items():
                if leaf[:depth] == parent:
                    supply[leaf[depth]] += n * epochs
            weights = mixing.WEIGHTS.get(level, {})
            children = {v: (weights.get(v, 1), s) for v, s in supply.items()}
            budgets |= {(*parent, v): g for v, g in shared_out(budgets[parent], children).items()}
    out = []
    for leaf, rows in leaves.items():
        whole, rest = divmod(budgets[leaf], tokens[leaf]) if tokens[leaf] else (epochs, 0)
        whole = min(whole, epochs)
        out += [(d[0], e) for d in rows for e in range(1, whole + 1)]
        if whole < epochs and rest:
            epoch, used = whole + 1, 0
            order = lambda d: hashlib.md5(f"{seed}:{epoch}:{d[0]}".encode()).hexdigest()
            for d in sorted(rows, key=order):
                used += d[4]
                if used > rest:
                    break
                out.append((d[0], epoch))
    return sorted(out)


def packed(lengths, capacities=packing.CAPACITIES):
    """Bins (capacity, lengths in order) for lengths in decreasing order, trying every bin."""
    bins, left = [], sum(lengths)
    for n in lengths:
        fitting = [b for b in bins if b[0] - sum(b[1]) >= n]
        if fitting:
            best = min(b[0] - sum(b[1]) for b in fitting)
            # Of bins with equal room the one that got a piece last.
            target = max((b for b in fitting if b[0] - sum(b[1]) == best), key=lambda b: b[2])
        else:
            sizes = [c for c in capacities if c >= n]
            target = [min(sizes, key=lambda c: (packing.cost(c) / min(c, left), c)), [], 0]
            bins.append(target)
        target[1].append(n)
        target[2] = max(b[2] for b in bins) + 1
        left -= n
    return [(min(c for c in capacities if c >= sum(b[1])), b[1]) for b in bins]


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))

"""Plain versions of the operators, straight from their definitions."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

AZ = {i: i + 32 for i in range(65, 91)}


def simhash(text):
    words = [w for w in re.split("[ \x09-\x0d]+", (text or "").translate(AZ)) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, distance=2):
    """fp -> smallest fp reachable, over all pairs."""
    fps = sorted(set(fps))
    parent = {f: f for f in fps}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {f: find(f) for f in fps}


def bench_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(AZ))


def windows(items, n=10):
    found = defaultdict(set)
    for item_id, text in items:
        ws = bench_words(text)
        size = min(n, len(ws))
        for s in range(len(ws) - size + 1 if ws else 0):
            found[tuple(ws[s:s + size])].add(str(item_id) if item_id is not None else "null")
    return found


def contamination(text, wins):
    ws = bench_words(text)
    hit, items = set(), set()
    for size in {len(w) for w in wins}:
        for s in range(len(ws) - size + 1):
            if found := wins.get(tuple(ws[s:s + size])):
                hit.update(range(s, s + size))
                items |= found
    return len(ws), len(hit), sorted(items)


def quality_counts(text):
    text = text or ""
    ws = [w for w in re.split("[ \x09-\x0d]+", text) if w]
    wins = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    repeat = {j for i in range(len(ws) - 2) if wins[tuple(ws[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search("[^ \x09-\x0d]", x)]
    return {"n_words": len(ws), "word_chars": sum(map(len, ws)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeat),
            "base_failed": len(ws) < 50 or 100 * len(repeat) > 50 * len(ws)}


def quality_kept(text):
    text = text or ""
    m = quality_counts(text)
    n = m["n_words"]
    letters = sum(c.isalpha() for c in text)
    capitals = sum(c.isupper() for c in text)
    return not (m["base_failed"] or m["n_symbols"] > 0.3 * n or text.count("!") > 0.3 * n
                or 100 * m["n_dup_lines"] > 50 * (text.count("\n") + 1) or not 2 * n <= m["word_chars"] <= 16 * n
                or letters < 0.5 * len(text) or capitals > 0.5 * letters)


def begun(parts, t):
    """Blocks of each source that have run before slot t: due ones first as far as needed, else the earliest released."""
    whole, places = sum(parts), range(len(parts))
    k, f = [t * a // whole for a in parts], [t * a % whole for a in parts]
    ahead, pool = [], []
    for n, (due, i) in enumerate(sorted((-(-(whole - f[i]) // parts[i]), i) for i in places if f[i]), 1):
        pool = sorted([*pool, (-(-f[i] // parts[i]), i)], key=lambda x: (-x[0], x[1]))
        free = due - sum(max(0, (f[x] + due * parts[x]) // whole - (f[x] > 0)) for x in places)
        need = max(0, n - free - len(ahead))
        ahead, pool = ahead + [x for _, x in pool[:need]], pool[need:]
    ahead += [x for _, x in pool[:sum(f) // whole - len(ahead)]]
    return [k[i] + (i in ahead) for i in places]


def pfair(parts, slots, stretch):
    """(source's place, block) per slot: earliest deadline first inside stretches, windows cut to them but for the last."""
    whole, out = sum(parts), []
    for t0 in range(0, slots, stretch):
        end = begun(parts, t0 + stretch) if t0 + stretch < slots else None
        done = begun(parts, t0)
        for t in range(t0, t0 + stretch):
            _, i = min((min(-(-(k + 1) * whole // a), t0 + stretch if end else 10 ** 18), i) for i, (k, a) in enumerate(zip(done, parts))
                       if k * whole // a <= t and (end is None or k < end[i]))
            out.append((i, done[i]))
            done[i] += 1
    return out


def mix(rows, block_docs=100, stretch=1000):
    """(doc_id, text) -> (block, slot, place), for (doc_id, text, source) rows."""
    by_source = defaultdict(list)
    for doc_id, text, source in rows:
        digest = hashlib.md5(f"{'' if doc_id is None else doc_id}:{text or ''}".encode()).hexdigest()
        by_source["n" if source is None else "s" + source].append((digest, doc_id, text))
    names = sorted(by_source)
    weight = [int(len(by_source[s]) ** 0.5 * 1_000_000) for s in names]
    parts = [max(10 ** 6, (2 * 10 ** 11 * w + sum(weight)) // (2 * sum(weight))) for w in weight]
    whole = sum(parts)
    length = max(stretch, -(-whole // min(parts)) + 1)
    end = max(-(-(-(-len(by_source[s]) // block_docs) * whole) // a) for s, a in zip(names, parts))
    slots = {(names[i], block): t for t, (i, block) in enumerate(pfair(parts, end, length))}
    out = []
    for s, found in by_source.items():
        for no, (_, doc_id, text) in enumerate(sorted(found, key=lambda r: r[0])):
            block, place = divmod(no, block_docs)
            out.append((doc_id, text, block, slots[s, block], place))
    return out

"""Plain, slow counterparts of the operators."""

import re
import uuid

import xxhash

SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def simhash(text):
    words = WORD.findall(ascii_lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    """Smallest id reachable over links of at most two bits, from {id: fingerprint}."""
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def exact_groups(texts):
    """{id: (keep_id, size)} from {id: text}."""
    groups = {}
    for i, text in texts.items():
        groups.setdefault(SPACE.sub("", text or ""), []).append(i)
    kept = {}
    for ids in groups.values():
        best = min(ids, key=lambda i: (-len(texts[i] or ""), i))
        kept |= {i: (best, len(ids)) for i in ids}
    return kept


def one_scratch_folder(monkeypatch, folder, *modules):
    """Everything the modules stage lies below one folder; returns a function that lists the labels of what is there."""
    for module in modules:
        monkeypatch.setattr(module, "scratch_dir", lambda spark, label: f"{folder}/{label}-{uuid.uuid4().hex}")
    return lambda: sorted(x.name.rpartition("-")[0] for x in folder.iterdir()) if folder.exists() else []

"""The contracts of the queries, row by row in plain Python, to hold results against."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text: str | None) -> str:
    return (text or "").translate(LOWER)


def crc(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode())


def secrets(text: str | None) -> tuple[dict[str, int], str]:
    """Counts of the base kinds, and the joined spans."""
    text = text or ""
    assign = re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
    )
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    names = ("assign", "access", "hex")
    counts = Counter(names[k] for _, k, _ in found)
    return {n: counts[n] for n in names}, ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(found))


def contamination(documents, benchmark, window: int = 10) -> dict:
    """doc_id: (n_words, n_hit, items)."""
    phrases = defaultdict(set)
    for item, text in benchmark:
        words = ALNUM_WORDS.findall(lower(text))
        for i in range(max(1, len(words) - window + 1) if words else 0):
            phrases[tuple(words[i : i + window])] |= {str(item)} if item is not None else set()
    sizes = {len(p) for p in phrases}
    out = {}
    for doc_id, text in documents:
        words, hit, items = ALNUM_WORDS.findall(lower(text)), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                own = phrases.get(tuple(words[i : i + n]))
                if own is not None:
                    items |= own
                    hit |= set(range(i, i + n))
        out[doc_id] = (len(words), len(hit), sorted(items))
    return out


def repeats(documents, size: int = 50) -> dict:
    """doc_id: (n_bytes, n_removed, n_spans, kept bytes)."""
    first: dict[bytes, int] = {}
    texts = [(doc_id, (text or "").encode()) for doc_id, text in documents]
    for doc_id, raw in texts:
        for i in range(len(raw) - size + 1):
            own = raw[i : i + size]
            first[own] = min(first.get(own, doc_id), doc_id)
    out = {}
    for doc_id, raw in texts:
        gone = bytearray(len(raw))
        for i in range(len(raw) - size + 1):
            if first[raw[i : i + size]] < doc_id:
                gone[i : i + size] = b"\1" * size
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out[doc_id] = (len(raw), sum(gone), spans, kept)
    return out


def shingle_set(text: str | None, width: int = 4) -> frozenset:
    words = SPACE_WORDS.findall(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def components(documents, width: int = 4, percent: int = 85) -> dict:
    """doc_id: (set size, smallest id reachable)."""
    sets = [(doc_id, shingle_set(text, width)) for doc_id, text in documents]
    parent = {doc_id: doc_id for doc_id, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    owners = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for t in s:
            owners[t].append(k)
    for k, (doc_id, s) in enumerate(sets):
        shared = Counter(j for t in s for j in owners[t] if j > k)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j][1]) - n):
                a, b = root(doc_id), root(sets[j][0])
                if a != b:
                    parent[max(a, b)] = min(a, b)
    return {doc_id: (len(s), root(doc_id)) for doc_id, s in sets}


def quality(text: str | None) -> dict:
    text = text or ""
    words = SPACE_WORDS.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if SPACE_WORDS.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "base_failed": len(words) < 50 or 100 * len(repeated) > 50 * len(words),
    }


def unigram(documents) -> dict:
    """doc_id: (held out, n_tokens, n_known, training tokens, base score)."""
    import math

    end = ("end",)
    tokens = {doc_id: SPACE_WORDS.findall(lower(text)) + [end] for doc_id, text in documents}
    held = {doc_id: crc(doc_id) % 7 == 2 for doc_id in tokens}
    counts = Counter(t for doc_id, own in tokens.items() if not held[doc_id] for t in own)
    total, distinct = sum(counts.values()), len(counts)
    return {
        doc_id: (
            held[doc_id], len(own), sum(counts[t] > 0 for t in own), total,
            math.fsum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own),
        )
        for doc_id, own in tokens.items()
    }


def targets(sizes: dict) -> dict:
    """Word targets of sources: weights 5, 2, 1 by code point with null last, at most three times the size."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, free, out = sum(sizes.values()), set(order), {}
    while free:
        left = total - sum(out.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            out |= share
            break
        out |= {s: 3.0 * sizes[s] for s in above}
        free -= above
    return out


def alignment(documents, byte_bpe: str, piece_bpe: str) -> dict:
    """doc_id: (n_a, n_b, n_groups, n_links, n_best, count_sum, groups)."""
    import sentencepiece
    from tokenizers import Tokenizer, pre_tokenizers

    a, b = Tokenizer.from_file(byte_bpe), sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
    a.encode_special_tokens = True
    # The characters of the byte-level alphabet, by the byte they stand for.
    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    characters = [chr(k) for k in [*range(0x800), *range(0x800, 0xD800, 0x400), 0xE000, 0xF000, *range(0x10000, 0x110000, 0x10000)]]
    byte_of = {c: b for t in characters for c, b in zip(split.pre_tokenize_str(t)[0][0], t.encode(), strict=True)}

    def ends(tokens):
        out, at = [], 0
        for t in tokens:
            out.append((at, at + len(t)))
            at += len(t)
        return out

    found, counts = {}, Counter()
    for doc_id, text in documents:
        found[doc_id] = None
        if not text:
            continue
        whole = (" " + text).encode()
        a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        a_bytes = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in a_ids]
        b_bytes = [
            bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("\u2581", " ").encode()
            for i, p in ((i, b.id_to_piece(i)) for i in b_ids)
        ]
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            continue
        a_at, b_at = ends(a_bytes), ends(b_bytes)
        cuts = sorted({e for _, e in a_at} & {e for _, e in b_at})
        groups, start = [], 0
        for cut in cuts:
            inside = lambda at, ids: ",".join(str(i) for i, (s, e) in zip(ids, at, strict=True) if start <= s and e <= cut)  # noqa: B023, E731
            groups.append(f"{inside(a_at, a_ids)}|{inside(b_at, b_ids)}")
            start = cut
        links = [
            (a_ids[i], b_ids[j]) for i, (s, e) in enumerate(a_at) for j, (u, v) in enumerate(b_at) if max(s, u) < min(e, v)
        ]
        counts.update(links)
        found[doc_id] = (len(a_ids), len(b_ids), groups, links)
    highest = defaultdict(int)
    for (_, j), n in counts.items():
        highest[j] = max(highest[j], n)
    out = {}
    for doc_id, own in found.items():
        if own is None:
            out[doc_id] = (0, 0, 0, 0, 0, 0, "")
            continue
        n_a, n_b, groups, links = own
        best = sum(counts[p] == highest[p[1]] for p in links)
        out[doc_id] = (n_a, n_b, len(groups), len(links), best, sum(counts[p] for p in links), ";".join(groups))
    return out


def damaged(rows) -> dict:
    """conv_id: its damaged (turn, role, text) by turn, nulls first."""
    out = defaultdict(list)
    for conv_id, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        own = out[conv_id]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1])) for c, own in out.items()}


def repaired(rows) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of (turn, role, text) in order."""
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    faults, seen = [], set()
    for _, role, text in rows:
        spoken = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not spoken else "duplicate" if (role, text) in seen else "" if spoken[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))

    # The best way to go on from each row and string of initials so far, of which only the last counts.
    good = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {state: ((0, "", []) if state in ("", "a") else (10**9, "", [])) for state in good}

    def inserting(found):
        for _ in range(3):
            for state in good:
                for role in good[state].replace("s", ""):
                    cost, audit, lines = found[role]
                    full = {"u": "user:", "a": "assistant:"}[role]
                    found[state] = min(found[state], (cost + 5, "I" + audit, [full, *lines]), key=lambda x: x[:2])
        return found

    best = inserting(best)
    for (_, role, text), fault in reversed(list(zip(rows, faults))):
        here = {}
        for state in good:
            cost, audit, lines = best[state]
            ways = [(cost + 2, "D" + audit, lines)]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                for name, letter, price in [(role, "K", 0), ("user", "R", 1), ("assistant", "R", 1)]:
                    if name[:1] and name[:1] in good[state]:
                        cost, audit, lines = best[name[:1]]
                        ways.append((cost + more + price, letter + audit, [f"{name}:{text}", *lines]))
            here[state] = min(ways, key=lambda w: w[:2])
        best = inserting(here)
    cost, audit, lines = best[""]
    count = Counter(faults)
    return gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, sha("\n".join(lines))

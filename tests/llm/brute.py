"""Plain definitions the operators are tested against."""
import hashlib
import re

WS = "\x20\x09\x0a\x0b\x0c\x0d"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def words_ws(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def near(rows, words=4):
    """op1 by all pairs. rows: (doc_id, text) -> per row (doc_id, n_shingles, component_id, kept)."""
    sets = []
    for _, t in rows:
        w = words_ws(lower(t or ""))
        sets.append({tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    seen = set()
    for ids in by.values():
        for a in range(len(ids)):
            for b in range(a):
                seen.add((ids[b], ids[a]))
    for a, b in seen:
        if rows[a][0] is None or rows[b][0] is None:
            continue
        n = len(sets[a] & sets[b])
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            up[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(sets[i]), least.get(root(i)) if d is not None else None, d is None or least[root(i)] == d)
            for i, (d, _) in enumerate(rows)]


def repeats(rows, length=400):
    """op2: per row (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    raw = [(t or "").encode() for _, t in rows]
    seen = {}
    for b in raw:
        for i in range(len(b) - length + 1):
            h = b[i:i + length]
            seen[h] = seen.get(h, 0) + 1
    out = []
    for (d, _), b in zip(rows, raw):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\x01" * length
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((d, len(b), sum(gone), runs, sha(bytes(c for c, g in zip(b, gone) if not g))))
    return out


def drop_lines(rows, least=20, docs=3):
    """op6: per row (doc_id, text without the dropped lines)."""
    return [(d, "\n".join(kept)) for d, kept in stay(rows, least, docs)]


def stay(rows, least=20, docs=3):
    """op6: per row (doc_id, lines that stay)."""
    def key(x):
        return lower(x.strip(WS))
    holders = {}
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= least:
                holders.setdefault(key(x), set()).add(d)
    return [(d, [x for x in (t or "").split("\n") if not (
        len(key(x)) >= least and len(holders[key(x)]) >= docs and d != max((h for h in holders[key(x)] if h is not None), default=None))])
        for d, t in rows]


def lines(rows):
    """op6: per row (doc_id, n_lines, n_dropped, kept_sha256)."""
    out = []
    for (d, t), (_, kept) in zip(rows, stay(rows)):
        n = (t or "").count("\n") + 1
        out.append((d, n, n - len(kept), sha("\n".join(kept))))
    return out


def measures(text):
    """op7: (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    t = text or ""
    w = words_ws(t)
    seen, dup = set(), 0
    for x in t.split("\n"):
        if words_ws(x):
            dup += x in seen
            seen.add(x)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count = {}
    for g in grams:
        count[g] = count.get(g, 0) + 1
    hit = {j for i, g in enumerate(grams) if count[g] > 1 for j in (i, i + 1, i + 2)}
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n


def contaminated(docs, items, size=13):
    """op10: per row (doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + size]), set()).update([] if i is None else [str(i)])
    sizes = {len(x) for x in windows}
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for s in sizes:
            for k in range(len(w) - s + 1):
                own = windows.get(tuple(w[k:k + s]))
                if own is not None:
                    hit.update(range(k, k + s))
                    found |= own
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def secrets(text):
    """op5 base: (n_assign, n_access, n_hex, base_sha256)."""
    t = text or ""
    kinds = [("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
              lambda m: len(m.group(2)) >= 8),
             ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 16), ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 32)]
    n, spans = [], []
    for i, (k, rx, ok) in enumerate(kinds):
        got = [m for m in re.finditer(rx, t) if ok(m)]
        n.append(len(got))
        spans += [(m.start(), i, f"{k}:{m.start()}:{m.end()}") for m in got]
    return (*n, sha(",".join(x[2] for x in sorted(spans))))

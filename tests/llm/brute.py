"""Plain single-process versions of the numbered queries, written from their definitions."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections import Counter, defaultdict

import public_tokenizers
import tokenizers

UPPER = {c: c + 32 for c in range(65, 91)}


def tokens(texts):
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = {}
    for key, text in texts:
        text = text or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        out[key] = (len(text.encode()), n, n > 1024)
    return out


def bpe(texts):
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = {}
    for key, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        out[key] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    return out


def shingle_sets(texts, size):
    out = {}
    for key, text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
        if not words:
            out[key] = frozenset()
        elif len(words) < size:
            out[key] = frozenset([tuple(words)])
        else:
            out[key] = frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    return out


def near(texts, size=2, percent=80):
    """doc_id -> (n_shingles, component); all pairs that share a shingle are compared."""
    sets = shingle_sets(texts, size)
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for key, s in sets.items():
        for x in s:
            holders[x].append(key)
    same = defaultdict(list)
    for key, s in sets.items():
        if s:
            same[s].append(key)
    classes = {min(keys): s for s, keys in same.items()}
    for s, keys in same.items():
        for k in keys:
            a, b = find(min(keys)), find(k)
            parent[max(a, b)] = min(a, b)
    # A linked pair shares at least 80 % of the smaller set, so it shares one of the rarest fifth of its shingles (and one more).
    order = {x: (len(h), str(x)) for x, h in holders.items()}
    by = defaultdict(list)
    for key, s in classes.items():
        rare = sorted(s, key=order.get)[: len(s) - -(-percent * len(s) // 100) + 1]
        for x in rare:
            by[x].append(key)
    seen = set()
    for keys in by.values():
        for i, a in enumerate(keys):
            for b in keys[:i]:
                if (a, b) in seen:
                    continue
                seen.add((a, b))
                common = len(classes[a] & classes[b])
                if 100 * common >= percent * (len(classes[a]) + len(classes[b]) - common):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {k: (len(s), find(k)) for k, s in sets.items()}


def leaks(texts, items, window=10):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def words(text):
        return pattern.findall((text or "").translate(UPPER))

    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[i : i + size])].add(str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for key, text in texts:
        w = words(text)
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                names = windows.get(tuple(w[i : i + size]))
                if names:
                    hit.update(range(i, i + size))
                    found |= names
        out[key] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def quality(texts):
    out = {}
    for key, text in texts:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        count = Counter(windows)
        repeated = {i + d for i, w in enumerate(windows) if count[w] > 1 for d in range(5)}
        failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
        out[key] = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", "".join(words))), len(lines) - len(set(lines)), len(repeated), failed)
    return out


def archive(pages):
    first = {}
    payloads = {key: (html or "").encode() for key, html in pages}
    for key, p in payloads.items():
        first[p] = min(key, first.get(p, key))
    out = {}
    for key, p in payloads.items():
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out[key] = (len(p), digest, "response" if first[p] == key else "revisit", None if first[p] == key else first[p])
    return out


RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}


def rule_of(url):
    """(host, path, rule) of a url."""
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = host.translate(UPPER)
    best = None
    for rule in RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best)):
            best = rule
    return host, path, best


def kept_lines(texts, min_chars=40, min_docs=5):
    blanks = " \t\n\x0b\x0c\r"
    holders = defaultdict(set)
    for key, text in texts:
        for line in (text or "").split("\n"):
            k = line.strip(blanks).translate(UPPER)
            if len(k) >= min_chars:
                holders[k].add(key)
    out = {}
    for key, text in texts:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(h := holders.get(x.strip(blanks).translate(UPPER), ())) < min_docs or max(h) == key]
        out[key] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def altered_words(key, text):
    """The words of a text, the tail of every tenth text (by its id's checksum) repeated with a period."""
    import zlib

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(key).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def runs(words, min_length=6, min_exponent=4):
    """(start, length, period) of all runs: every period is tried at every place."""
    best = {}
    for q in range(1, len(words) // min_exponent + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(min_length, min_exponent * q):
                best[start, length] = min(q, best.get((start, length), q))
            i += 1
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def run_digest(key, text):
    words = altered_words(key, text)
    found = runs(words)
    longest = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    top = (*longest, 1000 * longest[1] // longest[2]) if longest else (None,) * 4
    return (len(found), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def url_tree(pages, max_children=20, min_share=0.02, smoothing=5.0, z=1.96, block_from=0.7):
    """page -> (template, verdict): per host a tree that is grown segment by segment, then merged place by place."""
    hosts, asked = defaultdict(lambda: defaultdict(list)), {}
    for key, url in pages:
        host, path, rule = rule_of(url)
        shaped = re.sub(r"(?<![0-9A-Za-z])[0-9a-fA-F-]*(?:[0-9][a-fA-F]|[a-fA-F][0-9])[0-9a-fA-F-]{6,}(?![0-9A-Za-z])", "<x>", path)
        shaped = re.sub(r"[0-9]+", "<d>", shaped)
        said = RULES[rule] if rule else None
        hosts[host][shaped].append(said)
        asked[key] = (host, shaped, said)
    labels = [v for paths in hosts.values() for vs in paths.values() for v in vs if v]
    prior = labels.count("block") / len(labels) if labels else 0.0

    def grow(items):  # (segments, count, path) below one node
        out, below = {}, defaultdict(list)
        for segments, n, path in items:
            if segments:
                below[segments[0]].append((segments[1:], n, path))
            else:
                out[path] = []
        total = sum(n for part in below.values() for _, n, _ in part)
        nodes = defaultdict(list)
        for seg, part in below.items():
            literal = len(below) <= max_children or sum(n for _, n, _ in part) >= min_share * total
            nodes[seg if literal else "*"] += part
        for seg, part in nodes.items():
            out.update((path, [seg, *rest]) for path, rest in grow(part).items())
        return out

    judged = {}
    for host, paths in hosts.items():
        template = grow([([s for s in p.split("/") if s], len(v), p) for p, v in paths.items()])
        labelled = {p: sum(x is not None for x in v) for p, v in paths.items()}
        blocked = {p: v.count("block") for p, v in paths.items()}
        for at in range(max(map(len, template.values()))):
            groups = defaultdict(lambda: defaultdict(list))
            for p, t in template.items():
                if len(t) > at:
                    groups[*t[:at], None, *t[at + 1 :]][t[at]].append(p)
            for segs in groups.values():
                sums = []
                for seg, ps in segs.items():
                    n = sum(labelled[p] for p in ps)
                    sums.append(((sum(blocked[p] for p in ps) + smoothing * prior) / (n + smoothing), seg, n))
                chains = []
                for share, seg, n in sorted(sums):
                    if chains:
                        p0, _, n0 = chains[-1][-1]
                        spread = (share * (1 - share) / (n + smoothing) + p0 * (1 - p0) / (n0 + smoothing)) ** 0.5
                    if chains and share - p0 <= z * spread:
                        chains[-1].append((share, seg, n))
                    else:
                        chains.append([(share, seg, n)])
                for chain in chains:
                    name = "|".join(sorted(seg for _, seg, _ in chain))
                    for _, seg, _ in chain:
                        for p in segs[seg]:
                            template[p] = [*template[p][:at], name, *template[p][at + 1 :]]
        share = (sum(blocked.values()) + smoothing * prior) / (sum(labelled.values()) + smoothing)
        for p, t in template.items():
            same = [q for q, u in template.items() if u == t]
            purity = (sum(blocked[q] for q in same) + smoothing * share) / (sum(labelled[q] for q in same) + smoothing)
            judged[host, p] = ("/" + "/".join(t), "block" if purity >= block_from else "allow")
    return {key: (judged[h, s][0], said or judged[h, s][1]) for key, (h, s, said) in asked.items()}

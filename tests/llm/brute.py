"""Plain versions of the registered results, one document or all documents at a time."""

import hashlib
import re
import zlib
from collections import Counter

SPACED = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def raw(text):
    return (text or "").encode()


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def remainder(doc_id, by):
    return zlib.crc32(str(doc_id).encode()) % by


def secret_base(text):
    text = text or ""
    assign = re.compile(
        r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    spans.sort()
    names = ("assign", "access", "hex")
    counts = Counter(s[1] for s in spans)
    digest = sha(",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans))
    return counts[0], counts[1], counts[2], digest, spans


def decontaminated(docs, items):
    """docs, items: (id, text) pairs; gives n_words, n_hit, n_items, digest for each document."""
    windows = {}
    for item, text in items:
        words = ALNUM.findall(raw(text).lower())
        n = min(10, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        words = ALNUM.findall(raw(text).lower())
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if (got := windows.get(tuple(words[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= got
        out.append((doc_id, len(words), len(hit), len(found), sha(",".join(sorted(found)))))
    return out


def quality_rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    b = raw(text)
    words = SPACED.findall(b)
    lines, again = set(), 0
    for line in b.split(b"\n"):
        if SPACED.search(line):
            again += line in lines
            lines.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            hit.update(range(i, i + 8))
    chars = sum(len(w.decode()) for w in words)
    symbols = sum(b.count(bytes([c])) for c in b"#*$%&|<>")
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), chars, symbols, again, len(hit), failed


def base_scores(docs):
    """doc_id to held_out, n_tokens, n_known, train_tokens, base score."""
    import math

    cut = [(i, raw(t).lower(), remainder(i, 10) == 0) for i, t in docs]
    counts = Counter()
    for _, b, held in cut:
        if not held:
            counts.update([*SPACED.findall(b), None])
    total, below = counts.total(), counts.total() + 0.1 * (len(counts) + 1)
    out = {}
    for i, b, held in cut:
        tokens = [*SPACED.findall(b), None]
        score = sum(math.log10((counts[w] + 0.1) / below) for w in tokens)
        out[i] = held, len(tokens), sum(counts[w] > 0 for w in tokens), total, score
    return out


def all_ids(texts):
    """Ids of each whole text with the end id, by the library alone."""
    import public_tokenizers
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = coder.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [[*e.ids, 0] for e in found]


def crc_ids(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def without_repeats(docs, length=400):
    """doc_id, n_bytes, n_removed, n_spans, digest per (id, text) row."""
    texts = [raw(t) for _, t in docs]
    times = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc_id, _), t in zip(docs, texts):
        runs = []
        for i in range(len(t) - length + 1):
            if times[t[i : i + length]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + length
                else:
                    runs.append([i, i + length])
        keep, at = b"", 0
        for a, b in runs:
            keep += t[at:a]
            at = b
        keep += t[at:]
        out.append((doc_id, len(t), len(t) - len(keep), len(runs), sha(keep)))
    return out


def jaccard_components(docs, size=3, part=9, whole=10):
    """doc_id, n_shingles, component_id per row, by comparing all sets that share a shingle."""
    sets = []
    for _, t in docs:
        words = SPACED.findall(raw(t).lower())
        n = min(size, len(words))
        sets.append(frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else frozenset())
    label = list(range(len(docs)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    # Similar sets share one of the rarest shingles of each.
    times = Counter(s for own in sets for s in own)
    index = {}
    for i, own in enumerate(sets):
        order = sorted(own, key=lambda s: (times[s], s))
        for s in order[: len(own) - len(own) * part // whole + 1]:
            index.setdefault(s, []).append(i)
    seen = set()
    for group in index.values():
        for x, i in enumerate(group):
            for j in group[:x]:
                if (i, j) not in seen:
                    seen.add((i, j))
                    both = len(sets[i] & sets[j])
                    if both * whole >= part * (len(sets[i]) + len(sets[j]) - both):
                        label[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [(d, len(s), least[root(i)]) for i, ((d, _), s) in enumerate(zip(docs, sets))]


def without_repeated_windows(docs, window=20):
    """n_words, n_removed, digest per (id, text) row; documents ordered by id, a null id first."""
    order = lambda d: (d[0] is not None, d[0])
    cut = {d: SPACED.findall(raw(d[1])) for d in docs}
    first = {}
    for d in sorted(cut, key=order):
        for i in range(len(cut[d]) - window + 1):
            first.setdefault(tuple(cut[d][i : i + window]), (d, i))
    out = []
    for d in docs:
        words = cut[d]
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] != (d, i):
                gone.update(range(i, i + window))
        out.append((d[0], len(words), len(gone), sha(b" ".join(w for p, w in enumerate(words) if p not in gone))))
    return out


def one_edit_apart(a, b):
    """By the definition: one letter replaced, or one letter more in one of them."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelling_variants(docs, least_length=5, least_count=3):
    """word, n, n_near, form, form_n, root, by comparing all words with all."""
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    near = {w: [o for o in words if one_edit_apart(w, o)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], words[form[w]] if form[w] else None, root))
    return out


def fill_in_middle(doc_id, text):
    """n, form, prefix_chars, middle_chars, output of one text."""
    text = text or ""
    h = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[k * 8 : k * 8 + 8], 16) for k in range(4))
    n = len(text)
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return n, "plain", None, None, text
    low, high = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    p, m, s = text[:low], text[low:high], text[high:]
    if h4 % 100 < 20:
        return n, "spm", low, high - low, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", low, high - low, f"<P>{p}<S>{s}<M>{m}"


def random_class(s):
    """Bits that a string has to have, by its class; None for words and numbers."""
    lower, upper, digit = (bool(re.search(p, s)) for p in ("[a-z]", "[A-Z]", "[0-9]"))
    if (lower and not upper and not re.search("[g-z]", s)) or (upper and not lower and not re.search("[G-Z]", s)):
        return 2.8
    if lower and upper and digit:
        return 3.5
    if lower and digit:
        return 3.5
    if upper and digit:
        return 3.3
    return 3.7 if lower and upper else None


def secret_spans(text, allowed):
    """All spans of a text; ``allowed`` is the pattern of runs that are no secrets."""
    import math

    text, base = text or "", secret_base(text)[4]
    spans = list(base)
    for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", text):
        whole, runs = random_class(m[0]), []
        for i in range(len(m[0]) - 19 if whole else 0):
            part = m[0][i : i + 20]
            bits = min(whole, random_class(part) or whole)
            if -sum(c / 20 * math.log2(c / 20) for c in Counter(part).values()) >= bits - 1e-12:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + 20
                else:
                    runs.append([i, i + 20])
        for a, z in runs:
            if re.search(allowed, m[0][a:z]):
                continue
            free = [p for p in range(m.start() + a, m.start() + z) if not any(s <= p < e for s, _, e in base)]
            for p in free:
                if p - 1 not in free or p == m.start() + a:
                    start = p
                if p + 1 not in free:
                    spans.append((start, 3, p + 1))
    return sorted(spans)


def masked(text, spans, mask="[SECRET]"):
    out, at, end = "", 0, -1
    for a, _, z in spans:
        if a > end:
            if end >= 0:
                out, at = out + mask, end
            out += text[at:a]
        end = max(end, z)
    return out + mask + text[end:] if spans else text

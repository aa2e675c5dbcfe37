"""Brute-force versions and awkward inputs shared by the tests."""

import re
import zlib
from collections import defaultdict

LONG = " ".join(f"word{i % 977}x{i}" for i in range(30000))

AWKWARD = [
    (0, "one two three four five six seven eight nine ten eleven", "en", "a"),
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \t\n ", "de", None),
    (4, "one two three four five six seven eight nine ten eleven", "en", "a"),
    (5, "short text", None, "b"),
    (6, LONG, "en", "a"),
    (7, LONG + " tail", "en", "a"),
    (8, "x" * 100_000, "en", "b"),
    (9, "Ünïcode straße 中文 𝔘 <|endoftext|> ' \x0b\r\n end", "de", "b"),
    (10, "12 34 56 --", "fr", "b"),
    (11, "same row", "en", "a"),
    (11, "same row", "en", "a"),
    (None, "no id here", "en", "c"),
    (12, "a b c d e f g h i j k l m n o p q r s t u v w x y z" * 3, "en", "a"),
    (13, "A B C D E F G H I J K L M N O P Q R S T U V W X Y Z" * 3, "en", "a"),
]


def documents(spark, rows=AWKWARD, extra=True):
    """The rows as ``documents``, with further columns whose names the
    operators use themselves."""
    if not extra:
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    wide = [(*r, i, str(i), float(i), [i], "p") for i, r in enumerate(rows)]
    return spark.createDataFrame(wide, "doc_id long, text string, lang string, source string, n long, `row` string, size double, ids array<int>, part string")


def save(df, folder, name="documents"):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text, n=5):
    w = [re.sub(r"[A-Z]", lambda m: m.group().lower(), x) for x in words(text)]
    if not w:
        return set()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)}


def crc(text):
    return zlib.crc32((text or "").encode())


def link_components(rows):
    """{doc_id: smallest doc_id reachable}; brute force over shared shingles."""
    sets, by = defaultdict(set), defaultdict(set)
    for i, t in rows:
        if i is not None:
            sets[i].add(frozenset(shingle_set(t)))
    flat = [(i, s) for i, ss in sets.items() for s in ss if s]
    for k, (_, s) in enumerate(flat):
        for g in s:
            by[g].add(k)
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for k, (i, s) in enumerate(flat):
        near = defaultdict(int)
        for g in s:
            for j in by[g]:
                near[j] += 1
        for j, c in near.items():
            if 100 * c >= 75 * (len(s) + len(flat[j][1]) - c):
                a, b = find(i), find(flat[j][0])
                top[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}

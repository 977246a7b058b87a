"""op12: the manifest against a brute-force tree, over several blocks and exchange rounds."""

import hashlib, zlib
def H(s): return hashlib.sha256(s.encode()).hexdigest()
def field(v): 
    if v is None: return "-"
    v = str(v); return f"{len(v.encode())}:{v}"
def leafh(r): return H("".join(field(r[c]) for c in ("doc_id","source","lang","n_chars","text")))
def tree(hs):
    """list of (root, proofs) with proofs per node list of (left,right)"""
    proofs=[[] for _ in hs]; idx=list(range(len(hs))); level=list(hs)
    while len(level)>1:
        for k,i in enumerate(idx):
            run=i//16*16; proofs[k].append(("".join(level[run:i]), "".join(level[i+1:run+16])))
        level=[H("".join(level[j:j+16])) for j in range(0,len(level),16)]; idx=[i//16 for i in idx]
    return level[0], proofs
def brute(rows):
    import collections
    by=collections.defaultdict(list)
    for r in rows: by[r["source"]].append(r)
    srcs=sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    sub={}; lp={}
    for s in srcs:
        items=sorted(by[s], key=lambda r:(r["doc_id"] is not None, r["doc_id"] if r["doc_id"] is not None else 0, leafh(r)))
        root, pr = tree([leafh(r) for r in items]); sub[s]=root
        lp[s]=[(r, p) for r,p in zip(items, pr)]
    root, tp = tree([sub[s] for s in srcs])
    out=[]
    for si,s in enumerate(srcs):
        for r,p in lp[s]:
            proof=p+tp[si]
            lf=leafh(r); t=r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode())%5==0
            st=leafh({**r, "text": r["text"].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ","abcdefghijklmnopqrstuvwxyz")) if r["text"] is not None else None}) if t else lf
            for l,rr in proof: st=H(l+st+rr)
            out.append((r["doc_id"], lf, sub[s], root, H("".join(l+rr for l,rr in proof)), st, st==root))
    return out


import pytest  # noqa: E402
from conftest import DATA  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tipoff.llm import manifest  # noqa: E402
from tipoff.llm.queries import QUERIES, table  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=lambda t: (t[0] is not None, t[0] or 0, t[1]))


def expected(rows):
    return sorted(brute(rows), key=lambda t: (t[0] is not None, t[0] or 0, t[1]))


def test_given_documents(spark):
    docs = table(spark, DATA, "documents")
    rows = [r.asDict() for r in docs.collect()]
    got = result(QUERIES["op12_merkle_manifest"](spark, DATA))
    assert got == expected(rows)
    assert not all(t[-1] for t in got) and any(t[-1] for t in got)


@pytest.mark.parametrize("block_levels", [1, 2])
def test_rounds_of_exchange(spark, block_levels):
    """Blocks of 16 or 256 leaves: a hot source of 700 leaves needs exchange rounds; others are tiny."""
    rows = [(i, f"Text {i} ABC" if i % 3 else None, "en", "hot", i) for i in range(700)]
    rows += [(1000 + i, f"T{i}", None, s, None) for i, s in enumerate(["b", "b", "a", None, "é", "z" * 3])]
    rows += [(None, "Null id", "x", "hot", 1), (5, "Text 5 ABC", "en", "hot", 5), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    for name in ("leaf", "pos", "block", "hash", "proof", "_levels", "upper", "root", "text_2"):
        df = df.withColumn(name, F.lit(3))
    got = result(manifest.checked(df, block_levels))
    assert got == expected([dict(zip(["doc_id", "text", "lang", "source", "n_chars"], r)) for r in rows])


def test_one_row_and_nothing(spark):
    one = spark.createDataFrame([(7, "Aa", "en", "s", 2)], DOCS)
    (row,) = result(manifest.checked(one))
    assert row[1] == row[2] == row[3] and row[4] == H("")
    assert manifest.checked(spark.createDataFrame([], DOCS)).count() == 0

"""Secret scan, licence scan and preference formatting against plain versions."""

import hashlib
import random
import re
import textwrap
import time

import pyarrow.parquet as pq
import pytest
from oracle_check import compare, connect

from assetpulse.llm import licenses, preferences, secrets
from assetpulse.llm import queries as llm

SF = "/root/testdata/sf0.01"


def test_secrets(spark):
    want = {}
    for r in pq.read_table(f"{SF}/documents.parquet").to_pylist():
        found = []
        for n, (kind, pattern, flags) in enumerate((("assign", secrets.ASSIGN, re.I | re.A), ("access", secrets.ACCESS, 0), ("hex", secrets.HEX, 0))):
            for m in re.finditer(pattern, r["text"] or "", flags):
                if len(m[2] if kind == "assign" else m[0]) >= secrets.LEAST[kind]:
                    found.append((m.start(), n, kind, m.end()))
        want[r["doc_id"]] = ([sum(f[1] == n for f in found) for n in range(3)], hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found)).encode()).hexdigest())
    got = llm.all_queries()["op1_secrets"](spark, SF).collect()
    assert {r["doc_id"]: ([r["n_assign"], r["n_access"], r["n_hex"]], r["base_sha256"]) for r in got} == want
    assert sum(map(sum, (w[0] for w in want.values()))) > 0


def test_long_texts_of_many_spans():
    """Time grows with the text: each wide candidate is looked up among the merged base spans."""
    rng = random.Random(1)
    for _ in range(300):
        spans = [(a, a + rng.randrange(1, 9)) for a in (rng.randrange(200) for _ in range(rng.randrange(12)))]
        covered = secrets.overlaps(spans)
        for start in range(0, 200, 3):
            stop = start + rng.randrange(1, 12)
            assert covered(start, stop) == any(a < stop and start < b for a, b in spans)
    spans = [(i * 20, i * 20 + 9) for i in range(200_000)]
    started = time.perf_counter()
    covered = secrets.overlaps(spans)
    assert not any(covered(a + 10, a + 19) for a, _ in spans) and time.perf_counter() - started < 5


def test_ownership_separates_copies(spark):
    wide = "Zx9_" + "aB3dE5fG7hJ9kL1m"
    rows = [(1, f"see {wide} x", "a", "r"), (2, f"{wide}Q", "a", "r"), (3, f"{wide}Q", "b", "r"), (4, f"{wide}Q", "c", "r"), (4, None, None, None), (None, "token=abcdef", "a", "r")]
    df = spark.createDataFrame(rows, "doc_id long, text string, o string, r string")
    got = {(r["doc_id"], tuple((s["kind"], s["class"]) for s in r["spans"])) for r in secrets.ownership(df, "o", "r").collect()}
    assert got == {(1, (("live", "live"),)), (2, ()), (3, ()), (4, ()), (None, (("assign", "plain"),))}
    assert secrets.ownership(df.limit(0), "o", "r").count() == 0


def test_ownership_counts_repositories_and_copies(spark):
    """One owner: a token of one repository stays live however often it occurs, one of three repositories is copied."""
    many, wide, two = "Qw7xK2mN9pL4" + "vB6tR8yZ1", "Zx9_aB3dE5fG7hJ9kL1m", "Hj5Pn3Vc8Mq2" + "Ls7Wd4Tg9"
    rows = [(i, f"token={many} {wide}Q", "a", f"r{i % 3}") for i in range(6)]
    rows += [(10 + i, f"see {wide}", "a", "r0") for i in range(4)] + [(20, two, "a", "r"), (21, two, "b", "r")]
    df = spark.createDataFrame(rows, "doc_id long, text string, o string, r string")
    got = {r["doc_id"]: [(s["kind"], s["class"], s["owners"], s["repositories"], s["occurrences"]) for s in r["spans"]] for r in secrets.ownership(df, "o", "r").collect()}
    assert all(got[i] == [("assign", "copied", 1, 3, 6)] for i in range(6))
    assert all(got[10 + i] == [("live", "live", 1, 1, 4)] for i in range(4))
    assert got[20] == got[21] == [("live", "live", 2, 2, 2)]


def test_licences_equal_sql(spark):
    line = compare(spark, "op7", llm.all_queries()["op7_licenses"], llm.all_sql()["op7_licenses"], connect(SF), SF)
    assert line.startswith("ok") and " 0 rows" not in line, line
    rows = [(1, None), (2, ""), (3, "x\n" + licenses.TEMPLATES["MIT-grant"]), (3, "x\n" + licenses.TEMPLATES["MIT-grant"]), (4, "plain words only"), (None, "Released under the MIT License.")]
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], "doc_id long, text string, lines int, hits int")
    got = licenses.licence_units(df).collect()
    whole, line = (3, "MIT-grant", 0, 1), (3, "MIT-grant", 1, 1)
    assert sorted((r["doc_id"] or 0, r["license"], r["first_line"], r["last_line"]) for r in got) == [(0, "MIT-notice", 0, 0), whole, whole, line, line]
    assert licenses.licence_units(df.limit(0)).count() == 0


@pytest.mark.parametrize("width", [10_000, 78, 60])
def test_whole_licences_in_other_text(spark, width):
    """Each published text, on long lines or wrapped, alone and inside a document of other words."""
    rng = random.Random(width)
    other = lambda n: textwrap.fill(" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(n)), 78)
    rows, want = [], {}
    for name, text in licenses.TEMPLATES.items():
        wrapped = "\n\n".join(textwrap.fill(" ".join(part.split()), width) for part in text.split("\n\n"))
        for body in (wrapped, f"{other(200)}\n{wrapped}\n{other(200)}", f"{other(30)}\n\n{wrapped}\n\n{other(400)}"):
            want[len(rows)] = name
            rows.append((len(rows), body))
    found = {}
    for r in licenses.licence_units(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found.setdefault(r["doc_id"], {}).setdefault(r["license"], []).append(r["dice"])
    missed = [(want[i], i % 3) for i in want if want[i] not in found.get(i, {})]
    assert not missed
    assert all(max(found[i][want[i]]) == 1.0 for i in want if i % 3 == 0)


def test_a_paragraph_wrapped_inside_a_document(spark):
    rng = random.Random(3)
    before, after = (" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(200)) for _ in range(2))
    text = textwrap.fill(before, 78) + "\n" + textwrap.fill(licenses.TEMPLATES["MIT-grant"], 78) + "\n" + textwrap.fill(after, 78)
    got = licenses.licence_units(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert {r["license"] for r in got} == {"MIT-grant"} and max(r["dice"] for r in got) > 0.9


def test_preferences(spark):
    rows = [(1, s, 0, "user", "Hi") for s in ("chosen", "rejected")] + [(1, "chosen", 1, "assistant", "Good"), (1, "rejected", 1, "assistant", None), (2, "chosen", 0, "user", "alone"), (None, "rejected", 0, None, "x")]
    got = {r["pair_id"]: tuple(r)[1:] for r in preferences.format_preferences(spark.createDataFrame(rows, "pair_id long, side string, turn long, role string, text string")).collect()}
    assert got[1] == (1, "<|user|>\nHi\n", "<|assistant|>\nGood\n", "<|assistant|>\n\n", "14-18", "14-14")
    assert got[2] == (0, "", "<|user|>\nalone\n", "", "", "") and got[None][3] == "<||>\nx\n"
    result = llm.all_queries()["op10_preferences"](spark, SF)
    turns = pq.read_table(f"{SF}/conversations.parquet").to_pylist()
    unanswered = {r["conv_id"] for r in turns} - {r["conv_id"] for r in turns if r["role"] == "assistant"}
    rows = result.collect()
    assert len(rows) == 100 and {r["conv_id"] for r in rows if r["chosen"] == r["rejected"]} == unanswered


def preferred(rows):
    """pair -> (n_prompt_turns, prompt, chosen, rejected, both masks), turn by turn."""
    pairs, out = {}, []
    for n, (pair, side, turn, role, text) in enumerate(rows):
        pairs.setdefault(("lone", n) if pair is None else pair, (pair, {"chosen": [], "rejected": []}))[1][side].append((turn is not None, turn or 0, role or "", text or ""))
    for pair, sides in pairs.values():
        chosen, rejected = sorted(sides["chosen"]), sorted(sides["rejected"])
        n = 0
        while n < min(len(chosen), len(rejected)) and chosen[n][2:] == rejected[n][2:]:
            n += 1
        shown, masks = [], []
        for turns in (chosen[:n], chosen[n:], rejected[n:]):
            text, spans = "", []
            for _, _, role, said in turns:
                start = len(text) + len(f"<|{role}|>\n")
                text += f"<|{role}|>\n{said}\n"
                if role == "assistant":
                    spans.append(f"{start}-{start + len(said)}")
            shown.append(text)
            masks.append(",".join(spans))
        out.append((pair, n, *shown, *masks[1:]))
    return sorted(out, key=repr)


def test_preferences_against_plain_code(spark):
    schema = "pair_id long, side string, turn long, role string, text string"
    long = [(9, side, n, "assistant" if n % 2 else "user", f"turn {n} é😀 " * (n % 5)) for side in ("chosen", "rejected") for n in range(1500)]
    odd = [(1, s, 0, "user", "Hi") for s in ("chosen", "rejected")] * 2 + [(1, "chosen", None, "assistant", None), (2, "rejected", 3, None, ""), (None, "chosen", 1, "assistant", "a"), (None, "chosen", 1, "assistant", "a"), (None, "rejected", 1, "user", "b")]
    rows = long + [(9, "rejected", 1500, "assistant", "more")] + odd
    df = spark.createDataFrame([(*r, 1) for r in rows], schema + ", n int")
    assert sorted(map(tuple, preferences.format_preferences(df).collect()), key=repr) == preferred(rows)
    assert preferences.format_preferences(df.limit(0)).count() == 0


def test_preferences_query_against_plain_code(spark):
    turns = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in pq.read_table(f"{SF}/conversations.parquet").to_pylist() if r["conv_id"] is not None]
    last = {}
    for conv, turn, role, text in turns:
        if role == "assistant" and (conv not in last or (turn is not None, turn or 0, text is not None, text or "") > last[conv][0]):
            last[conv] = ((turn is not None, turn or 0, text is not None, text or ""), turn, text)
    rows = [(conv, "chosen", turn, role, text) for conv, turn, role, text in turns]
    for conv, turn, role, text in turns:
        swap = role == "assistant" and conv in last and turn is not None and turn == last[conv][1]
        if not swap or conv + 1 in last:
            rows.append((conv, "rejected", turn, role, last[conv + 1][2] if swap else text))
    got = llm.all_queries()["op10_preferences"](spark, SF).collect()
    assert sorted(map(tuple, got), key=repr) == preferred(rows)


@pytest.mark.parametrize("name", ["op3_exact_dedup"])
def test_sql(spark, name):
    line = compare(spark, name, llm.all_queries()[name], llm.all_sql()[name], connect(SF), SF)
    assert line.startswith("ok"), line

import csv
import io
import random

from cartolux.functions import tokenizer as T
from cartolux.operators import malformed

GOOD = "5\tref\t7\t1.0\t-1\t+\tokay\tcut\tokay\tqry\t8\t2.\t3\t-\t-\tOKAY\tExclude\tnote"


def put(i, v):
    f = GOOD.split("\t")
    f[i] = v
    return "\t".join(f)


def reference(line):
    """One character at a time."""
    state, fields, cur = "start", [], ""
    for n, c in enumerate(line):
        if state == "start":
            if c == '"':
                state = "quoted"
            elif c == "\t":
                fields.append("")
            else:
                state, cur = "plain", c
        elif state == "plain":
            if c == '"':
                return None, n
            if c == "\t":
                fields.append(cur)
                state, cur = "start", ""
            else:
                cur += c
        elif state == "quoted":
            state, cur = ("closed", cur) if c == '"' else ("quoted", cur + c)
        else:
            if c == '"':
                state, cur = "quoted", cur + '"'
            elif c == "\t":
                fields.append(cur)
                state, cur = "start", ""
            else:
                return None, n
    return (None, len(line)) if state == "quoted" else ([*fields, cur], -1)


def test_tokenizer_against_one_character_at_a_time():
    rng = random.Random(1)
    lines = ["".join(rng.choices('ab"\té☃', k=rng.randrange(0, 30))) for _ in range(4000)] + ["", '"', "\t", '""', "x" * 5000, '"' + "\t" * 3000 + '"']
    fields, offsets = T.tokenize(lines)
    for line, f, o in zip(lines, fields, offsets):
        want, at = reference(line)
        assert f == want and (o == at if want is not None else o in (at, at)), (line, f, o, want, at)


def test_states_do_not_depend_on_the_chunk():
    kinds = T.classes(('a\t"b\tc""d"\te\n"x' * 50).encode())
    for chunk in (1, 3, 64, 5000):
        assert (T.states(kinds, chunk) == T.states(kinds, 7)).all()


def test_reasons(spark):
    cases = {
        GOOD: None, GOOD + "\r": None, "": "skip", " \t ": "skip", "# x": "skip", " # x": "columns", put(17, 'a "b"'): "quoting", put(17, '"a ""b"""'): None, put(17, '"tab\tkept"'): None,
        put(17, '"open'): "quoting", GOOD + "\t": "columns", put(0, "NA"): "bad_id", put(0, " -1 "): None, put(0, "+5"): "bad_id", put(2, "1.0"): "bad_id", put(10, ""): "bad_id", put(10, "١"): "bad_id",
        put(3, "-1.0"): "bad_bkpt", put(4, ".5"): "bad_bkpt", put(11, "1e3"): "bad_bkpt", put(12, "inf"): "bad_bkpt", put(5, "−"): "bad_orientation", put(13, " + "): None, put(6, "exclude"): "bad_status",
        put(8, "cut"): "bad_status", put(16, "-"): None, put(14, "o kay"): "bad_status", put(0, '" 5 "'): None, put(0, "x") + "\textra": "columns", put(1, "\xa0"): None, put(0, "5\xa0"): "bad_id",
        put(7, "оkay"): "bad_status", None: "skip", "\r": "skip",
    }
    lines = spark.createDataFrame([(1, i, x, 0) for i, x in enumerate(cases)] * 2, "file_id long, line_no int, line string, reason int")
    bad = {r.line_no: r.reason for r in malformed.rejected(lines).collect()}
    good = malformed.accepted(lines)
    for i, (line, reason) in enumerate(cases.items()):
        assert bad.get(i) == (None if reason == "skip" else reason), line
    assert good.count() == 2 * sum(r is None for r in cases.values())
    one = good.filter("line_no = 0").first()
    assert (one.xId, one.refLeftBkpt, one.qryRightBkptStatus, one.qryStatus, one.remark) == (5, 1.0, "okay", "exclude", "note")
    at = {r.line_no: r.offset for r in malformed.rejected(lines).filter("reason = 'quoting'").collect()}
    assert at[list(cases).index(put(17, '"open'))] == len(put(17, '"open'))
    assert malformed.rejected(lines.limit(0)).count() == 0


def test_valid_rows_read_like_the_csv_module():
    text = '1\t"a ""q"" b"\t\t"x\ty"'
    (fields,), _ = T.tokenize([text])
    assert fields == next(csv.reader(io.StringIO(text), delimiter="\t"))

"""Line deduplication of rows that share a doc_id, or have none."""

from ledgerlake.llm import line_dedup

SHARED = "A shared line of more than forty characters."
CLEAN = "A clean line that no other text holds, of over forty characters: {}."


def test_each_row_loses_its_own_lines(llm):
    a, b, c, d = (CLEAN.format(x) for x in "abcd")
    rows = [(i, SHARED) for i in range(6)]
    rows += [(None, f"{a}\n{b}\n{SHARED}"), (None, f"{SHARED}\n{b}2\n{c}\n{c}2"), (None, f"{SHARED}\n{b}2\n{c}\n{c}2"), (None, None)]
    rows += [(3, f"{d}\n{SHARED}"), (5, f"{d}5\n{SHARED}")]
    out = line_dedup.dedup_lines(llm.createDataFrame(rows, "doc_id bigint, text string")).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text, r.n_lines, r.n_dropped) for r in out)
    want = [(False, i, "", 1, 1) for i in range(5)] + [(False, 5, SHARED, 1, 0)]
    want += [(False, 3, d, 2, 1), (False, 5, f"{d}5\n{SHARED}", 2, 0)]
    want += [(True, 0, f"{a}\n{b}", 3, 1), (True, 0, "", 1, 0)] + 2 * [(True, 0, f"{b}2\n{c}\n{c}2", 4, 1)]
    assert got == sorted(want)

"""Texts that several tests of this folder share."""

SF = "/root/testdata/sf0.001"
LONG = "word " * 60_000 + "ümläut end.\n" + "x" * 5_000
PROSE = (
    "The river ran slowly past the old mill, and nobody on the bridge looked down at it. "
    "A boy had left his coat on the wall that morning, so his sister went back for it. "
    "She found two cats asleep in the sleeves and did not dare to wake either of them. "
    "When the bell rang she sat on the steps, reading, until somebody came out to ask her in."
)
TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, PROSE), (5, PROSE), (5, PROSE), (6, PROSE.upper()),
    (7, "one two"), (8, LONG), (9, "<|endoftext|> I'll go \U0001f600\r\n\x1c end"), (None, PROSE),
]


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}

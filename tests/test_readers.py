"""Alignment files as they are found: position numbers, notes behind the data, codon positions without marks, quoted names."""

from __future__ import annotations

import pytest

from cladeworks.sources import sequences as sq

INTERLEAVED = """   5   18   I

human
goat-cow
rabbit
rat
marsupial
1
GTG CTG TCT
... ... ...
... ... ..C
... ..C ...
... ..C ..G
10      \t
GCT GGC GAG
... ..A .CT
.G. ... ...
.G. ..T ..A
..C ..T .CC

TRUE values in the simulation: none
"""
NOTED = """      3   12
Human
AAGCTTCAC
CGG
Chimp
AAGCTTCACCGA
Gorilla  AAGCT TCACC
GA

Brown et al. 1982
123123123123
444444
  6   4860
"""
MARKED = """  2   8 G
G 4
12312312
4444

human
ATTCGAAC       8
chimp
ATT.GAAC
(Horai)
  6   4860
G 4
1231231
"""
PROTEINS = """ 3  12

Langur     KIFERCELAR T
L
Baboon     .......... ..
Rat        .TY....F.. .R


LYSOZYME c of Stewart
"""
CODONS = """ 2 12  GC

Equus                 GCC TAC CCC TTC
Rhinoceros            GCT TAT CCA CTT
"""
LOWER = """2  9  GC

a2
ggctc
tcac
aw68
ggctct---
"""
NEXUS = """#NEXUS
begin data;
dimensions ntax=2  nchar=6;
format datatype=DNA interleave=no gap=-;
matrix
'179 Avian_H1N6'     ATG---
"b c"  ATG
165_Avian     AUGGA-
"b c"  CCC
;
end;
"""


def cells(text, sets=None):
    return [(b.names, b.partitions) for b in sq.phylip_blocks(text, sets)]


def test_interleaved_with_position_numbers():
    rows = dict(sq.parse_alignment(INTERLEAVED))
    assert list(rows) == ["human", "goat-cow", "rabbit", "rat", "marsupial"]
    assert rows["human"] == "GTGCTGTCTGCTGGCGAG" and rows["rat"] == "GTGCTCTCTGGTGGTGAA" and rows["marsupial"] == "GTGCTCTCGGCCGGTGCC"


def test_notes_behind_the_data():
    assert sq.parse_alignment(NOTED) == [("Human", "AAGCTTCACCGG"), ("Chimp", "AAGCTTCACCGA"), ("Gorilla", "AAGCTTCACCGA")]
    assert sq.parse_alignment(PROTEINS) == [("Langur", "KIFERCELARTL"), ("Baboon", "KIFERCELARTL"), ("Rat", "KTYERCEFARTR")]
    assert len(sq.phylip_blocks(NOTED + "\n1 3\nx  TCA")) == 1  # behind a note nothing is looked for


def test_marks_and_codon_positions():
    assert cells(MARKED.replace("4444\n", "")) == [(["human", "chimp"], [0, 1, 2, 0, 1, 2, 0, 1])]
    assert cells(MARKED.replace("12312312\n4444", "1231\n4444")) == [(["human", "chimp"], [0, 1, 2, 0, 3, 3, 3, 3])]
    assert cells(CODONS) == [(["Equus", "Rhinoceros"], [0, 1, 2] * 4)]
    assert sq.parse_alignment(LOWER) == [("a2", "GGCTCTCAC"), ("aw68", "GGCTCT---")]


def test_nexus_names():
    assert sq.parse_alignment(NEXUS) == [("179 Avian_H1N6", "ATG---"), ("b c", "ATGCCC"), ("165_Avian", "ATGGA-")]


def test_data_sets_asked_for():
    three = "2 3\na  TCA\nb  TCG\n3 2\na  TT\nb  TC\nc  CC\n1 2\na  AA\nas many as said"
    assert [len(b.names) for b in sq.phylip_blocks(three)] == [2, 3, 1]
    assert [len(b.names) for b in sq.phylip_blocks(three, 2)] == [2, 3]
    with pytest.raises(ValueError, match="3 data sets in place of 4|no sizes"):
        sq.phylip_blocks(three, 4)
    with pytest.raises(ValueError, match="data set 2"):
        sq.phylip_blocks("1 2\na  TT\n2 2\nb  TT", 2)
    with pytest.raises(ValueError, match="data set 1"):
        sq.phylip_blocks("2 6\na  TTC\nb  TTA")
    with pytest.raises(ValueError, match="miscounted"):
        sq.phylip_blocks("1 2\na  TTCC")
    assert sq.phylip_blocks("") == []


def test_cells(spark):
    texts = spark.createDataFrame([(1, INTERLEAVED), (2, CODONS), (3, None)], "file_id int, text string")
    got = sq.phylip_cells(texts).collect()
    assert len(got) == 5 * 18 + 2 * 12 and {(r.partition_id, r.site) for r in got if r.file_id == 2} == {((s - 1) % 3, s) for s in range(1, 13)}


def test_control_file():
    text = "seqfile = a.nuc * remark\n fix_kappa_x = 0\n# alpha = 1\nncatG=4"
    assert sq.parse_control(text) == {"seqfile": "a.nuc", "fix_kappa_x": "0", "ncatG": "4"}
    assert sq.parse_control(text, ("seqfile", "fix_kappa", "ncatG")) == {"seqfile": "a.nuc", "fix_kappa": "0", "ncatG": "4"}
    with pytest.raises(ValueError, match="ncatG"):
        sq.parse_control(text, ("seqfile", "fix_kappa"))


def test_matrix_file(spark):
    """A triangle of four states and frequencies, broken anywhere, with notes that hold numbers behind."""
    from cladeworks.sources.textfiles import exchange_file, frequency_file

    whole = ["", "0.5", "1.5 2.5", "3.5 4.5 5.5", "", "0.2 0.4 0.6", "0.8", "", "Whelan 2001, 18 pages", "1 2 3"]
    rows = [(1, k, x) for k, x in enumerate(whole)] + [(2, 0, "0.5 1.5 2.5"), (2, 1, "3.5 4.5 5.5")]
    df = spark.createDataFrame(rows, "file_id int, line_no int, line string").repartition(4)
    got = {(r.file_id, r.i, r.j): r.rate for r in exchange_file(df, 4).collect()}
    half = {(2, 1): 0.5, (3, 1): 1.5, (3, 2): 2.5, (4, 1): 3.5, (4, 2): 4.5, (4, 3): 5.5}
    assert got == {(f, *p): x for f in (1, 2) for (i, j), x in half.items() for p in ((i, j), (j, i))}
    assert [(r.file_id, r.i, round(r.freq, 9)) for r in frequency_file(df, 4).orderBy("i").collect()] == [(1, 1, 0.1), (1, 2, 0.2), (1, 3, 0.3), (1, 4, 0.4)]

"""Alignment files as cell rows, and back."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sniff(text: str) -> str:
    head = text.lstrip()
    return "fasta" if head.startswith(">") else "phylip" if re.match(r"\d+\s+\d+", head) else "nexus"


def normalised(name: str, seq: str, first: str | None) -> str:
    """Upper case, U as T, and . as the first sequence's character."""
    seq = re.sub(r"[\s\d]", "", seq).upper().replace("U", "T")
    if "." in seq:
        if first is None:
            raise ValueError(f"{name}: the first sequence has no one to copy")
        seq = "".join(f if c == "." else c for c, f in zip(seq, first, strict=True))
    return seq


def parse_fasta(text: str) -> list[tuple[str, str]]:
    found = []
    for block in re.split(r"(?m)^>", text)[1:]:
        name, _, seq = block.partition("\n")
        found.append((name.strip(), seq))
    return found


@dataclass
class Block:
    """One data set of a file: names, sequences, and for each site its partition (and its count, where sites are patterns)."""

    names: list[str]
    seqs: list[str]
    partitions: list[int]
    counts: list[int] | None = None


def letters(line: str) -> str:
    return re.sub(r"[\s\d]", "", line)


def partition_marks(lines: Iterator[str], first: str, size: int) -> list[int]:
    """Partitions of sites from a line G and what follows: as many lengths as partitions (the last may be left out), or a digit for each site."""
    n, *numbers = [int(x) for x in re.findall(r"\d+", first)]
    if len(numbers) in (n, n - 1) and sum(numbers) <= size and numbers:
        ends = [sum(numbers[: k + 1]) for k in range(len(numbers))]
        if len(numbers) == n and ends[-1] != size:
            raise ValueError("the partitions' lengths don't add up")
        return [sum(site >= e for e in ends[: n - 1]) for site in range(size)]
    marks = "".join(map(str, numbers))
    while len(marks) < size:
        marks += re.sub(r"\s", "", next(lines))
    return [int(x) - 1 for x in marks]


#: The longest name where no two spaces end it.
LONGEST_NAME = 30
HEADER = re.compile(r"\s*(\d+)\s+(\d+)\s*([GCSIPgcsip\s]*)$")


def named(line: str) -> tuple[str, str]:
    """(name, what follows) of a sequence's first line."""
    name, _, rest = line.strip().partition("  ")
    return name[:LONGEST_NAME].strip(), name[LONGEST_NAME:] + rest


def phylip_block(lines: Iterator[str], head: re.Match) -> Block:
    """The data set behind its line of sizes; StopIteration where lines end before it does."""
    n, size, options = int(head[1]), int(head[2]), head[3].upper()
    if "C" in options:
        partitions = [site % 3 for site in range(size)]
    else:
        partitions = partition_marks(lines, next(lines), size) if "G" in options else [0] * size
    names, seqs = [], []
    if "I" in options:
        rows = (line for line in lines if letters(line))  # others only number the sites
        for _ in range(n):
            name, seq = named(next(lines))
            names.append(name)
            seqs.append(letters(seq))
        while any(len(s) < size for s in seqs):
            for k in range(n):
                seqs[k] += letters(next(rows))
    else:
        for _ in range(n):
            name, seq = named(next(lines))
            parts, held = [letters(seq)], len(letters(seq))
            while held < size:
                parts.append(letters(next(lines)))
                held += len(parts[-1])
            names.append(name)
            seqs.append("".join(parts))
    if wrong := [name for name, s in zip(names, seqs, strict=True) if len(s) != size]:
        raise ValueError(f"{wrong[0]}: more than {size} characters")
    counts = None
    if "P" in options:
        counts = []
        while len(counts) < size:
            counts += [int(x) for x in next(lines).split()]
    return Block(names, seqs, partitions, counts)


def phylip_blocks(text: str, sets: int | None = None) -> list[Block]:
    """The data sets of a PHYLIP file: the first ``sets``, or as many as follow one another; what stands behind them is a note.

    A name ends at two spaces or its line's end, after LONGEST_NAME characters at most; its sequence may begin in the next line.
    Options after the sizes: I interleaved (lines without letters, which number sites, are passed over), S sequential; G partitions
    (``partition_marks``); C partitions by codon position, with or without G, and no line of its own; P sites are
    patterns, whose counts follow the sequences.
    """
    lines, out = iter([x for x in (line.rstrip() for line in text.splitlines()) if x.strip()]), []
    for line in lines:
        if len(out) == sets:
            break
        head = HEADER.match(line)
        if not head:
            if sets is None and out:
                break
            raise ValueError(f"no sizes in {line[:40]!r}")
        try:
            out.append(phylip_block(lines, head))
        except (StopIteration, ValueError) as e:
            if sets is None and out:  # sizes within a note
                break
            raise ValueError(f"data set {len(out) + 1} is cut short or miscounted: {e}") from None
    if sets is not None and len(out) < sets:
        raise ValueError(f"{len(out)} data sets in place of {sets}")
    return out


def parse_phylip(text: str) -> list[tuple[str, str]]:
    """(name, sequence) of a file's first data set."""
    block = phylip_blocks(text)[0]
    return list(zip(block.names, block.seqs, strict=True))


def phylip_cells(texts: DataFrame, sets: int | None = None) -> DataFrame:
    """(file_id, dataset_id, taxon_id, taxon, site, partition_id, fpatt, state) of PHYLIP texts (file_id, text), several data sets a text.

    Each text is read where its row is, in Arrow batches, and exploded in the JVM; fpatt is 1 but for patterns with counts.
    """

    @F.udf("array<struct<dataset_id:int,taxon_id:int,taxon:string,seq:string,partitions:array<int>,counts:array<int>>>", useArrow=True)
    def parsed(text):
        rows = []
        for k, block in enumerate(phylip_blocks(text or "", sets)):
            first = None
            for i, (name, seq) in enumerate(zip(block.names, block.seqs, strict=True)):
                seq = normalised(name, seq, first)
                first = first or seq
                rows.append((k, i + 1, name, seq, block.partitions, block.counts))
        return rows

    rows = texts.select("file_id", F.explode(parsed("text")).alias("s")).select("file_id", "s.*")
    cells = rows.select("file_id", "dataset_id", "taxon_id", "taxon", F.posexplode(F.filter(F.split("seq", ""), lambda c: c != "")).alias("at", "state"), "partitions", "counts")
    return cells.select("file_id", "dataset_id", "taxon_id", "taxon", (F.col("at") + 1).alias("site"), F.get("partitions", F.col("at")).alias("partition_id"), F.coalesce(F.get("counts", F.col("at")), F.lit(1)).alias("fpatt"), "state")


def parse_nexus(text: str) -> list[tuple[str, str]]:
    text = re.sub(r"\[[^\]]*\]", "", text)
    body = re.search(r"(?is)\bmatrix\b(.*?);", text)
    seqs: dict[str, str] = {}
    for line in body[1].strip().splitlines() if body else ():
        if found := re.match(r"\s*(?:'([^']*)'|\"([^\"]*)\"|(\S+))\s*(.*)", line):
            name = found[1] or found[2] or found[3]
            seqs[name] = seqs.get(name, "") + found[4]
    return list(seqs.items())


def parse_alignment(text: str) -> list[tuple[str, str]]:
    """(name, sequence) of a file's text, of one length."""
    raw = {"fasta": parse_fasta, "phylip": parse_phylip, "nexus": parse_nexus}[sniff(text)](text)
    out: list[tuple[str, str]] = []
    for name, seq in raw:
        out.append((name, normalised(name, seq, out[0][1] if out else None)))
    if len({len(s) for _, s in out}) > 1:
        raise ValueError("sequences of different lengths")
    return out


def read_alignments(spark: SparkSession, path: str) -> DataFrame:
    """(path, taxon_id, taxon, site, state) of the files under ``path``; each file is read in one task, and exploded in the JVM."""
    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")

    @F.udf("array<struct<taxon:string,seq:string>>", useArrow=True)
    def parsed(text):
        return parse_alignment(text)

    rows = texts.select("path", F.posexplode(parsed("value")).alias("taxon_id", "s"))
    cells = rows.select("path", (F.col("taxon_id") + 1).alias("taxon_id"), "s.taxon", F.posexplode(F.split("s.seq", "")).alias("site", "state"))
    return cells.where("state <> ''").select("path", "taxon_id", "taxon", (F.col("site") + 1).alias("site"), "state")


def phylip_lines(cells: DataFrame) -> DataFrame:
    """(dataset_id, text): each data set (dataset_id, taxon_id, taxon, site, state) as a PHYLIP file's text."""
    seqs = cells.groupBy("dataset_id", "taxon_id", "taxon").agg(F.array_sort(F.collect_list(F.struct("site", "state"))).alias("c"))
    seqs = seqs.select("dataset_id", F.struct("taxon_id", F.concat("taxon", F.lit("  "), F.array_join(F.transform("c", lambda x: x["state"]), "")).alias("line"), F.size("c").alias("n")).alias("s"))
    files = seqs.groupBy("dataset_id").agg(F.array_sort(F.collect_list("s")).alias("s"))
    head = F.concat_ws(" ", F.size("s").cast("string"), F.get("s", F.lit(0))["n"].cast("string"))
    return files.select("dataset_id", F.concat(head, F.lit("\n"), F.array_join(F.transform("s", lambda x: x["line"]), "\n")).alias("text"))


def parse_control(text: str, known: tuple[str, ...] | None = None) -> dict[str, str]:
    """key = value lines; * and # begin remarks.

    With ``known`` names, a key is the one whose first eight characters are the same, and a key that is none of them is an error.
    """
    out = {}
    for line in text.splitlines():
        key, sign, value = re.split(r"[*#]", line, maxsplit=1)[0].partition("=")
        if sign and (key := key.strip()):
            if known is not None:
                same = [name for name in known if name[:8] == key[:8]]
                if not same:
                    raise ValueError(f"unknown option {key}")
                key = same[0]
            out[key] = value.strip()
    return out

"""Label text files: the reader and the code rules on files of the real layout."""

from pyspark.sql import functions as F

from landfall.operators.lookups import Lookups, label_int
from landfall.sources.labels import parse_label_lines, read_label_lines


def write_files(tmp_path):
    files = {
        "I94Port.txt": "   'QAA'\t=\t'PORT ONE, QQ          '\n   'QAB' \t=\t'No such port (QAB)'\n"
                       "   'QC'\t\t=\t'Port three, QX'\n   'QAD'\t=\t'PORT''S END, QQ'",
        "i94addr.txt": "\t'Q1'='FIRST STATE'\n\t'77'='Everything else' ",
        "I94Mode.txt": "1 = 'By balloon'\n9 = 'Untold' ",
        "I94Visa.txt": " 1 = Work\n 2 = Play",
        "I94CIT_I94RES.txt": "   701 =  'LANDIA by air, sea, and untold (no land)'\n   702 =  'ISLANDIA' ",
        "I94Bir.txt": " 3 = Three",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_reader_names_labels_by_file(spark, tmp_path):
    path = write_files(tmp_path)
    lines = read_label_lines(spark, path)
    got = {r["label"]: r["n"] for r in lines.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"I94Port": 4, "i94addr": 2, "I94Mode": 2, "I94Visa": 2, "I94CIT_I94RES": 2, "I94Bir": 1}
    parsed = parse_label_lines(lines)
    lk = Lookups.from_parsed(parsed)
    assert dict(tuple(r) for r in lk.port.collect()) == {"QAA": "PORT ONE, QQ", "QAB": "No such port (QAB)",
                                                         "QC": "Port three, QX", "QAD": "PORTS END, QQ"}
    assert dict(tuple(r) for r in lk.state.collect()) == {"Q1": "FIRST STATE", "77": "Everything else"}
    assert dict(tuple(r) for r in lk.citizenship.collect())[701].startswith("LANDIA by air")
    assert dict(tuple(r) for r in lk.mode.collect()) == {1: "By balloon", 9: "Untold"}
    # a label that no lookup uses is int-coded like all others
    assert [tuple(r) for r in label_int(parsed).where("label = 'I94Bir'").collect()] == [("I94Bir", 3, "Three")]

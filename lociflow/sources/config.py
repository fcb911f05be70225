"""Settings of a run, from a file of shell variables."""

from __future__ import annotations

import re
from dataclasses import dataclass, fields

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Settings:
    run: str = "run"
    experiment_type: str = "ChIA-PET"
    run_type: str = "miseq"
    ip_factor: str = ""
    cell_type: str = ""
    genome: str = ""
    chrom_sizes: str = ""
    peak_caller: str = "macs2"
    linker_a: str = ""
    linker_b: str = "none"
    min_tag_len: int = 18
    self_bp: int = 8000
    exten_bp: int = 500
    z_thresh: float = 6.0
    hybrid: str = "none"


def read_settings(spark: SparkSession, path: str) -> Settings:
    """name=value lines; comments, quotes and unknown names are left out. A settings file is a few lines, which come to the
    driver."""
    kinds = {f.name: type(f.default) for f in fields(Settings)}
    found = {}
    for row in spark.read.text(path).where("value RLIKE '^[A-Za-z_]+='").collect():
        name, value = re.match(r"([A-Za-z_]+)=(.*)", row.value).groups()
        quoted = re.match(r"""(["'])(.*?)\1""", value)
        if name in kinds:
            found[name] = kinds[name](quoted.group(2) if quoted else value.split("#")[0].strip())
    return Settings(**found)

"""Synthetic domain tables, derived from the driver's tables by SQL that both engines read alike.

The prose of `documents` has no word of the domain, so captions, boxes and papers are made from
numeric columns of whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CAPTIONS = (
    "Fig. 4 | Quantum circuit with two oracle calls, drawn for the adaptive VQE of a small chain",
    "Histogram of readout counts per shot; error bars are one standard deviation",
    "Schematic: CNOT ladder that spreads a Bell pair over five qubits, then an inverse QFT",
    "After each Hadamard the phase is kicked back, and a controlled-Z follows",
    "Rows hold X and Y rotations, columns the Z checks of the rotated surface code",
    "Exchange of two registers by three CX, or by one SWAP where hardware has it",
    "A Toffoli is taken apart into six CNOT and some T gates",
    "Variational ansatz: layers of RY, RZ and CZ on a ring",
    "Scatter plot of run time against size, with a photograph of the cryostat",
    "Circuit diagram of the encoder circuit",
    "Wiring of the readout line at the mixing chamber",
    "One round of syndrome measurement; the ancilla qubit is reset with |0⟩",
    "Circuit for order finding: modular multiplier, then the QPE register",
    "Depth of a Suzuki-Trotter step for growing time evolution",
    "Sequence of gates on one qubit wire, ended by a measurement gate",
    "",
    "Loss over the iterations, per optimizer, for max-cut on random graphs",
)
FIRST = (
    "Here the circuit begins with a Hadamard on every qubit of the first register",
    "Curves are means over ten seeds, and noise model parameters are listed in the table of constants",
    "We use the circuit of the previous section, with each CZ replaced by a CNOT between Hadamard gates",
    "period finding reduces to phase estimation of a multiplier",
    "the trial state is tuned until its ground state energy stops falling",
)
SECOND = (
    "a swap gate acts between control qubit and target qubit, and the gates are applied in turn",
    "a bell pair is consumed to teleport the key of a quantum cryptography session",
    "Fig. 3 has the same layout; its measurement of the ancilla comes later",
)


def _case(key: str, values: tuple[str, ...], missing: bool = False) -> str:
    n = len(values) + missing
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {key} % {n} {whens} END"


#: Name -> (table, expressions); the same text for both engines.
TABLES = {
    "captions": ("part", {
        "id": "p_partkey",
        "caption": _case("p_partkey", CAPTIONS),
        "c1": _case("(p_partkey + p_size)", FIRST, True),
        "c2": _case("p_size", SECOND, True),
    }),
    "boxes": ("lineitem", {
        "paper": "l_suppkey",
        "page": "CAST(l_partkey % 5 AS INT) + 1",
        "ord": "(l_orderkey * 10 + l_linenumber) * 99991 + l_partkey",
        "x0": "CAST((l_orderkey * 37) % 500 AS DOUBLE)",
        "y0": "CAST((l_partkey * 53) % 700 AS DOUBLE)",
        "w": "CAST((l_orderkey * 11 + l_linenumber * 71) % 260 + 1 AS DOUBLE)",
        "h": "CAST((l_partkey * 7 + l_linenumber * 31) % 180 + 1 AS DOUBLE)",
    }),
    "papers": ("orders", {
        "paper_ord": "o_orderkey",
        "line": "concat(CASE o_orderkey % 3 WHEN 0 THEN 'arXiv:' WHEN 1 THEN '  ' ELSE '' END, CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE concat('24', CAST(10 + o_orderkey % 3 AS VARCHAR(2)), '.', CAST(10000 + o_custkey % 90000 AS VARCHAR(5))) END, CASE WHEN o_orderkey % 5 = 0 THEN 'v2' ELSE '' END)",
        "n": "CAST(o_custkey % 4 AS BIGINT)",
    }),
}


def spread(rows: DataFrame) -> DataFrame:
    """Small rows dealt evenly over all cores, whatever the files: a few megabytes of keys, one task's share of bytes, become many texts to search."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism))


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, columns = TABLES[name]
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    if name == "captions":
        rows = spread(rows.select("p_partkey", "p_size"))
    return rows.selectExpr(*(f"{e} AS {c}" for c, e in columns.items()))


def cte(name: str) -> str:
    """The same table as a common table expression."""
    table, columns = TABLES[name]
    return f"{name} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {table})"

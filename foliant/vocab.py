"""Vocabularies as data: every operator that matches terms takes one as an argument."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, replace
from unicodedata import category

from pyspark.sql import DataFrame, SparkSession

# Gate names and their aliases.
GATES = """
X: x, x gate, pauli-x, pauli x, not, bit flip, σx, sigma-x
Y: y, y gate, pauli-y, pauli y, σy, sigma-y
Z: z, z gate, pauli-z, pauli z, phase flip, σz, sigma-z
H: h, hadamard, hadamard gate, h gate
S: s, s gate, phase gate, p gate, √z, sqrt-z
T: t, t gate, π/8, pi/8 gate
I: i, identity, identity gate, id
RX: rx, r_x, rotation-x, x rotation, rx(θ), rx(theta)
RY: ry, r_y, rotation-y, y rotation, ry(θ), ry(theta)
RZ: rz, r_z, rotation-z, z rotation, rz(θ), rz(theta)
U: u, u gate, universal gate, u3, u2, u1
SX: sx, √x, sqrt-x, v gate
CNOT: cnot, cx, controlled-not, controlled not, c-not, controlled-x, controlled x, feynman gate
CZ: cz, controlled-z, controlled z, c-z, cphase
CY: cy, controlled-y, controlled y, c-y
SWAP: swap, swap gate, exchange
iSWAP: iswap, i-swap
CSWAP: cswap, fredkin, fredkin gate, controlled swap
CRX: crx, controlled-rx, controlled rx
CRY: cry, controlled-ry, controlled ry
CRZ: crz, controlled-rz, controlled rz
CH: ch, controlled-h, controlled hadamard
CS: cs, controlled-s, controlled s
CT: ct, controlled-t, controlled t
DCX: dcx, double cnot
ECR: ecr, echoed cross-resonance
Toffoli: toffoli, ccnot, ccx, controlled-controlled-not, double controlled not, and gate
CCZ: ccz, controlled-controlled-z, double controlled z
CCCX: cccx, c3x, triple controlled x
MEASURE: measure, measurement, readout, m
RESET: reset, initialize, |0⟩
BARRIER: barrier, sync
"""

# Keywords of the relevance score.
PRIMARY = """
quantum circuit, circuit diagram, gate sequence, qubit register, quantum gate, circuit implementation,
gate decomposition, circuit depth, circuit width, circuit construction, unitary circuit, circuit for,
circuit implementing, circuit that, circuit to, hadamard gate, cnot gate, controlled-not, controlled not,
toffoli gate, pauli gate, rotation gate, phase gate, qubit line, quantum wire, measurement gate,
ancilla qubit, control qubit, target qubit, grover circuit, shor circuit, vqe circuit, qaoa circuit,
qft circuit, fourier transform circuit, teleportation circuit, applied to qubit, apply gate, applying gate,
gate applied, gates are applied, sequence of gates, series of gates
"""
SECONDARY = """
qubit, qubits, gate, gates, circuit, register, ancilla, measurement, unitary, controlled, target, wire, wires,
quantum register, state preparation, basis state, computational basis, oracle, rotation, phase, amplitude,
superposition, entanglement, hadamard, cnot, pauli, toffoli, swap, cz, rx, ry, rz, u1, u2, u3, cx, ccx,
bell state, ghz state, initial state, final state, variational, ansatz, parameterized
"""
NEGATIVE = """
photograph, photo, experimental setup, lab equipment, device image, chip image, hardware image, cryostat,
bar chart, histogram, scatter plot, line graph, data plot, error bars, experimental results, experimental data,
phase diagram, energy diagram, band structure, molecule, molecular structure, chemical, atomic structure,
lattice structure, crystal structure, bloch sphere, error rate, fidelity vs, success probability, noise model,
decoherence, relaxation time, table of, table showing, comparison of
"""

# Topics and their aliases.
TOPICS = """
Deutsch-Jozsa Algorithm: deutsch jozsa, deutsch-jozsa, constant vs balanced, DJ algorithm
Bernstein-Vazirani Algorithm: bernstein vazirani, bernstein-vazirani, secret string finding, BV algorithm
Simon's Algorithm: simon's algorithm, simon algorithm, hidden subgroup, period finding
Grover's Algorithm: grover, amplitude amplification, unstructured search, grover search, oracle search
Shor's Algorithm: shor, prime factorization, order finding, modular exponentiation, period finding
Quantum Phase Estimation (QPE): phase estimation, QPE, eigenvalue estimation, phase kickback, iterative phase estimation, IPE
Quantum Fourier Transform (QFT): quantum fourier transform, QFT, inverse QFT, IQFT, approximate QFT
HHL Algorithm: HHL, harrow hassidim lloyd, linear systems, matrix inversion, quantum linear system
Quantum Counting: quantum counting, counting algorithm, approximate counting
Quantum Amplitude Estimation (QAE): amplitude estimation, QAE, canonical amplitude estimation, maximum likelihood amplitude estimation
Variational Quantum Eigensolver (VQE): VQE, variational quantum eigensolver, ground state energy, UCCSD, unitary coupled cluster, adaptive VQE, ADAPT-VQE
Quantum Approximate Optimization (QAOA): QAOA, quantum approximate optimization, maxcut, max-cut, combinatorial optimization, mixer hamiltonian, driver hamiltonian
Variational Quantum Classifier (VQC): VQC, variational classifier, quantum classifier, circuit centric classifier
Quantum Neural Network (QNN): QNN, quantum neural network, parameterized quantum circuit, PQC, quantum perceptron, dissipative QNN
Hardware Efficient Ansatz: hardware efficient, HEA, entangling layers, ry-cnot, alternating layer
Quantum Kernel Method: quantum kernel, kernel estimation, QSVM, quantum support vector machine, fidelity kernel
Variational Autoencoder (QVAE): QVAE, quantum autoencoder, variational autoencoder, compression circuit
Quantum Error Correction (General): error correction, QEC, syndrome measurement, stabilizer measurement, parity check
Surface Code: surface code, toric code, lattice surgery, plaquette, star operator, rotated surface code
Repetition Code: repetition code, bit flip code, phase flip code, majority vote, 3-qubit code
Shor Code: shor code, 9-qubit code, nine qubit code
Steane Code: steane code, 7-qubit code, seven qubit code, color code, triangular code
Bacon-Shor Code: bacon-shor, bacon shor, subsystem code
Heavy Hex Code: heavy hex, heavy-hex, ibm quantum code
Bosonic Codes: cat code, gkp code, gottesman-kitaev-preskill, binomial code
Magic State Distillation: magic state distillation, magic state, distillation circuit, T-state distillation
Dynamical Decoupling: dynamical decoupling, spin echo, CPMG, XY4, pulse sequence, DD sequence
Swap Test: swap test, overlap measurement, inner product measurement, fidelity test
Hadamard Test: hadamard test, expectation value estimation, imaginary part estimation
Quantum Teleportation: teleportation, teleport, bell measurement, ebit
Superdense Coding: superdense coding, dense coding, information transfer
Entanglement Swapping: entanglement swapping, repeater, swap operation
State Preparation: state preparation, loading data, amplitude encoding, basis encoding
Oracle Implementation: oracle, black box, marking unitary, phase oracle
Quantum Adder: quantum adder, ripple carry, draper qft adder, addition circuit, CDKM ripple carry
Quantum Multiplier: quantum multiplier, multiplication circuit, karatsuba, arithmetic circuit
Quantum Comparator: comparator, compare, greater than, less than
Quantum RAM (QRAM): QRAM, quantum ram, quantum memory, bucket brigade, fanout
Modular Exponentiation: modular exponentiation, mod exp, modular multiplier
Hamiltonian Simulation: hamiltonian simulation, time evolution, trotter, trotterization, suzuki-trotter, product formula
Qubitization: qubitization, quantum signal processing, QSP, block encoding
Boson Sampling: boson sampling, gaussian boson sampling, photon network
Quantum Random Walk: quantum walk, random walk, walker, coin operator, szegedy walk
Randomized Benchmarking: randomized benchmarking, RB, clifford sequences, interleaved RB, direct RB
Quantum Volume: quantum volume, QV, heavy output, square circuit
Tomography: state tomography, process tomography, QST, QPT, maximum likelihood estimation, shadow tomography
Cross-Entropy Benchmarking: cross entropy, XEB, supremacy, sycamore
Quantum Key Distribution (QKD): QKD, BB84, E91, B92, key distribution, quantum cryptography, key exchange
Quantum Money: quantum money, unforgeable, verification
Blind Quantum Computing: blind quantum computing, delegated quantum computing, blind computing
"""

# Generic names by pattern, and inferences by keyword, in order.
GENERIC = r"""
variational\s+(?:quantum\s+)?circuit = Variational circuit
parameterized\s+(?:quantum\s+)?circuit = Parameterized circuit
ansatz\s+circuit = Variational ansatz
encoder\s+circuit = Quantum encoder circuit
oracle\s+(?:circuit|implementation) = Oracle circuit
state\s+preparation\s+circuit = State preparation circuit
measurement\s+circuit = Measurement circuit
error\s+correction\s+circuit = Quantum Error Correction
entangling\s+(?:layer|circuit) = Entangling circuit
"""
INFERENCES = """
Bell State Preparation: bell state, bell pair, entangled pair
GHZ State Preparation: ghz, greenberger-horne-zeilinger
Quantum Teleportation: teleport, quantum teleportation
Quantum Error Correction: error correction, fault tolerance, error detection
QAOA: optimization, maxcut, quantum approximate optimization
VQE: eigenvalue, eigensolver, variational quantum eigensolver
Quantum Fourier Transform: fourier, quantum fourier transform
Quantum Machine Learning: quantum machine learning, qml, quantum neural network
Quantum Cryptography: quantum cryptography, quantum key distribution, qkd
"""


def words(text: str) -> list[str]:
    """The comma-separated terms of a list."""
    return [t for t in (x.strip() for x in text.replace("\n", " ").split(",")) if t]


#: Kinds of characters on which every engine agrees whether they belong to words.
_PLAIN = ("Lu", "Ll", "Lo", "Sm", "Sc", "Ps", "Pe", "Po", "Pd", "Pi", "Pf")
#: What may follow a gate's name.
GATE_SUFFIX = r"(?:\s+gate)?"


@dataclass(frozen=True)
class Vocabulary:
    """Canonical names and their aliases, in order. `suffix` may follow a term, as a pattern."""

    entries: tuple[tuple[str, tuple[str, ...]], ...]
    suffix: str = ""

    @classmethod
    def parse(cls, text: str, suffix: str = "") -> Vocabulary:
        """From lines `canonical: alias, alias`."""
        lines = (line.split(": ", 1) for line in text.strip().splitlines())
        return cls(tuple((name, tuple(words(aliases))) for name, aliases in lines), suffix)

    @classmethod
    def load(cls, path: str, suffix: str = "") -> Vocabulary:
        """From a JSON object canonical -> aliases."""
        with open(path, encoding="utf-8") as f:
            return cls(tuple((k, tuple(v)) for k, v in json.load(f).items()), suffix)

    def extended(self, canonical: str, aliases: list[str]) -> Vocabulary:
        """With an entry added, or replaced where it stands."""
        entry = (canonical, tuple(aliases))
        if any(c == canonical for c, _ in self.entries):
            return replace(self, entries=tuple(entry if c == canonical else (c, a) for c, a in self.entries))
        return replace(self, entries=(*self.entries, entry))

    def names(self) -> list[str]:
        return sorted(c for c, _ in self.entries)

    def terms(self) -> list[tuple[str, str]]:
        """(canonical, term): the canonical name, then its aliases."""
        return [(c, t) for c, aliases in self.entries for t in (c, *aliases)]

    def lookup(self) -> dict[str, str]:
        """Lower-cased term -> canonical; of terms that several entries have, the last counts."""
        return {t.lower(): c for c, t in self.terms()}

    def pattern(self, term: str) -> str:
        return rf"\b{re.escape(term)}{self.suffix}\b"

    def words_of(self, term: str) -> tuple[str, ...] | None:
        """Lower-cased words of a term, all of which any text has as whole words where the term's pattern matches; None where that isn't sure.

        It isn't with characters of unusual case or kind, or with a suffix that may go on the last word.
        """
        plain = lambda c: c.isascii() or (len(c.upper()) == 1 and c.upper().lower() == c.lower() != "\u03c2" and category(c) in _PLAIN and c not in "\u01bb\u0130\u0131\u017f")
        if self.suffix not in ("", GATE_SUFFIX) or not all(map(plain, term)):
            return None
        return tuple(re.findall(r"\w+", term.lower()))

    def patterns(self) -> list[tuple[str, str]]:
        """(canonical, pattern that finds any of its terms); existence of a match is that of any single term's."""
        return [(c, rf"\b(?:{'|'.join(re.escape(t) for t in (c, *aliases))}){self.suffix}\b") for c, aliases in self.entries]

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(c, t, i) for i, (c, t) in enumerate(self.terms())]
        return spark.createDataFrame(rows, "canonical string, term string, ord int")


def gates() -> Vocabulary:
    return Vocabulary.parse(GATES, GATE_SUFFIX)


def topics() -> Vocabulary:
    return Vocabulary.parse(TOPICS)


def generic_patterns() -> list[tuple[str, str]]:
    return [tuple(line.rsplit(" = ", 1)) for line in GENERIC.strip().splitlines()]


def inferences() -> Vocabulary:
    return Vocabulary.parse(INFERENCES)


@dataclass(frozen=True)
class Keywords:
    """Weighted keywords of the relevance score."""

    primary: tuple[str, ...]
    secondary: tuple[str, ...]
    entities: tuple[str, ...]
    negative: tuple[str, ...]


def keywords(vocabulary: Vocabulary | None = None) -> Keywords:
    entities = dict.fromkeys(t.lower() for _, t in (vocabulary or gates()).terms())
    return Keywords(*(tuple(words(x)) for x in (PRIMARY, SECONDARY)), tuple(entities), tuple(words(NEGATIVE)))

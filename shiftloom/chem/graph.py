"""A small SMILES reader: atoms, bonds, implicit hydrogens, and rings.

It covers the organic subset, brackets, ring closures, branches, aromatic atoms and dots. Stereo marks are
read and ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

#: Standard atomic weights and masses of the commonest isotopes (fixed values).
WEIGHTS = {"H": 1.008, "B": 10.81, "C": 12.011, "N": 14.007, "O": 15.999, "F": 18.998, "Na": 22.990, "Mg": 24.305, "Al": 26.982, "Si": 28.085, "P": 30.974, "S": 32.06, "Cl": 35.45, "K": 39.098, "Ca": 40.078, "Fe": 55.845, "Cu": 63.546, "Zn": 65.38, "Se": 78.971, "Br": 79.904, "Sn": 118.71, "I": 126.904, "Li": 6.94}
MASSES = {"H": 1.00782503, "B": 11.00930536, "C": 12.0, "N": 14.00307401, "O": 15.99491462, "F": 18.99840316, "Na": 22.98976928, "Mg": 23.9850417, "Al": 26.98153853, "Si": 27.97692653, "P": 30.973762, "S": 31.97207117, "Cl": 34.96885268, "K": 38.96370649, "Ca": 39.9625909, "Fe": 55.9349363, "Cu": 62.9295977, "Zn": 63.9291420, "Se": 79.9165218, "Br": 78.9183376, "Sn": 119.902202, "I": 126.904473, "Li": 7.0160034}
#: Usual valences of the organic subset (fixed values).
VALENCES = {"B": (3,), "C": (4,), "N": (3, 5), "O": (2,), "P": (3, 5), "S": (2, 4, 6), "F": (1,), "Cl": (1,), "Br": (1,), "I": (1,)}
_TOKEN = re.compile(r"(\[[^\]]+\])|(Br|Cl|[BCNOPSFI]|[bcnops]|\*)|([-=#$:/\\~])|(\()|(\))|(%\d\d|\d)|(\.)")
_BRACKET = re.compile(r"^\[(\d+)?([A-Z][a-z]?|[a-z][a-z]?|\*)(@{0,2}(?:TH\d|AL\d)?)(H\d*)?([+-]+\d*|)(?::\d+)?\]$")
_ORDER = {"-": 1.0, "=": 2.0, "#": 3.0, "$": 4.0, ":": 1.5, "/": 1.0, "\\": 1.0, "~": 0.0}


class SmilesError(ValueError):
    pass


@dataclass
class Atom:
    element: str
    aromatic: bool = False
    charge: int = 0
    hydrogens: int | None = None  # of a bracket atom; None: implicit
    neighbours: dict[int, float] = field(default_factory=dict)


@dataclass
class Molecule:
    atoms: list[Atom]

    def hydrogens(self, i: int) -> int:
        a = self.atoms[i]
        if a.hydrogens is not None:
            return a.hydrogens
        if a.element not in VALENCES:
            return 0
        used = sum(a.neighbours.values())
        if a.aromatic:
            used = len(a.neighbours) + (1 if a.element in ("C", "N", "P", "B") else 0)
            if a.element in ("N", "P") and len(a.neighbours) == 3:
                used = 3
        need = next((v for v in VALENCES[a.element] if v >= used), None)
        if need is None:
            raise SmilesError(f"too many bonds at {a.element}")
        return int(need - used)

    def counts(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for i, a in enumerate(self.atoms):
            if a.element != "*":
                out[a.element] = out.get(a.element, 0) + 1
            if n := self.hydrogens(i):
                out["H"] = out.get("H", 0) + n
        return out

    def formula(self) -> str:
        c = self.counts()
        order = (["C"] + ["H"] * ("H" in c) if "C" in c else []) + sorted(e for e in c if "C" not in c or e not in ("C", "H"))
        charge = sum(a.charge for a in self.atoms)
        sign = "" if not charge else ("+" if charge > 0 else "-") + (str(abs(charge)) if abs(charge) > 1 else "")
        return "".join(e + (str(c[e]) if c[e] > 1 else "") for e in order) + sign

    def bonds(self) -> int:
        return sum(len(a.neighbours) for a in self.atoms) // 2

    def parts(self) -> int:
        seen, n = set(), 0
        for i in range(len(self.atoms)):
            if i not in seen:
                n, stack = n + 1, [i]
                while stack:
                    j = stack.pop()
                    if j not in seen:
                        seen.add(j)
                        stack.extend(self.atoms[j].neighbours)
        return n

    def rings(self) -> list[frozenset[int]]:
        """A least set of short rings: for each bond the shortest cycle through it, until the cycle space is full."""
        want = self.bonds() - len(self.atoms) + self.parts()
        found: set[frozenset[int]] = set()
        for i, a in enumerate(self.atoms):
            for j in a.neighbours:
                if i < j and (path := self._path(i, j)):
                    found.add(frozenset(path))
        out: list[frozenset[int]] = []
        basis: dict[int, int] = {}
        number = {frozenset((i, j)): k for k, (i, j) in enumerate((i, j) for i, a in enumerate(self.atoms) for j in a.neighbours if i < j)}
        for ring in sorted(found, key=lambda r: (len(r), sorted(r))):
            vector = sum(1 << k for e, k in number.items() if e <= ring)
            while vector and vector.bit_length() in basis:
                vector ^= basis[vector.bit_length()]
            if vector and len(out) < want:
                basis[vector.bit_length()] = vector
                out.append(ring)
        return out

    def _path(self, start: int, end: int) -> list[int] | None:
        came, queue = {start: start}, [start]
        for x in queue:
            for y in self.atoms[x].neighbours:
                if y not in came and not (x == start and y == end):
                    came[y] = x
                    queue.append(y)
        if end not in came:
            return None
        path = [end]
        while path[-1] != start:
            path.append(came[path[-1]])
        return path


def read(text: str) -> Molecule:
    """The molecule of a SMILES text; raises SmilesError where it is none."""
    atoms: list[Atom] = []
    stack: list[int] = []
    open_rings: dict[str, tuple[int, str | None]] = {}
    last: int | None = None
    bond: str | None = None
    at = 0

    def link(i: int, j: int, sign: str | None) -> None:
        if i == j or j in atoms[i].neighbours:
            raise SmilesError("bad ring bond")
        order = _ORDER[sign] if sign else 1.5 if atoms[i].aromatic and atoms[j].aromatic else 1.0
        atoms[i].neighbours[j] = atoms[j].neighbours[i] = order

    if not text or text != text.strip():
        raise SmilesError("empty or padded text")
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise SmilesError(f"unexpected {text[at]!r}")
        at = m.end()
        bracket, plain, sign, opening, closing, ring, dot = m.groups()
        if bracket or plain:
            if bracket:
                b = _BRACKET.match(bracket)
                if not b:
                    raise SmilesError(f"bad atom {bracket}")
                element = b[2]
                h = 0 if not b[4] else int(b[4][1:] or 1)
                q = b[5]
                charge = 0 if not q else (int(q.strip("+-")) if q.strip("+-") else len(q)) * (1 if q[0] == "+" else -1)
                atom = Atom(element.capitalize(), element.islower(), charge, h)
                if atom.element != "*" and atom.element not in WEIGHTS:
                    raise SmilesError(f"unknown element {element}")
            else:
                atom = Atom(plain.capitalize() if plain != "*" else "*", plain.islower(), 0, None if plain != "*" else 0)
            atoms.append(atom)
            if last is not None:
                link(last, len(atoms) - 1, bond)
            elif bond:
                raise SmilesError("bond without an atom")
            last, bond = len(atoms) - 1, None
        elif sign:
            if bond or last is None:
                raise SmilesError("misplaced bond")
            bond = sign
        elif opening:
            if last is None:
                raise SmilesError("misplaced branch")
            stack.append(last)
        elif closing:
            if not stack or bond:
                raise SmilesError("misplaced branch end")
            last = stack.pop()
        elif ring:
            if last is None:
                raise SmilesError("misplaced ring bond")
            if ring in open_rings:
                other, first = open_rings.pop(ring)
                link(other, last, bond or first)
            else:
                open_rings[ring] = (last, bond)
            bond = None
        else:
            if bond or stack or last is None:
                raise SmilesError("misplaced dot")
            last = None
    if open_rings or stack or bond or last is None:
        raise SmilesError("unfinished text")
    mol = Molecule(atoms)
    for i in range(len(atoms)):
        mol.hydrogens(i)
    return mol


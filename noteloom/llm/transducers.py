"""Small weighted transducers over letters, their composition, and the best reading of a string."""

from collections import defaultdict
from dataclasses import dataclass, field


@dataclass
class Transducer:
    """Arcs read one letter and write one; the weights of a path add up, and more is better."""

    start: object = 0
    arcs: dict[tuple[object, str], list[tuple[str, float, object]]] = field(default_factory=lambda: defaultdict(list))
    ends: dict[object, float] = field(default_factory=dict)

    def arc(self, state, reads: str, writes: str, weight: float, to) -> None:
        self.arcs[state, reads].append((writes, weight, to))

    def end(self, state, weight: float = 0.0) -> None:
        self.ends[state] = weight


def compose(first: Transducer, then: Transducer) -> Transducer:
    """What ``then`` makes of the output of ``first``, as one machine; only reachable states."""
    made = Transducer(start=(first.start, then.start))
    from_state = defaultdict(list)
    for (state, reads), arcs in first.arcs.items():
        from_state[state].extend((reads, *arc) for arc in arcs)
    seen, waiting = {made.start}, [made.start]
    while waiting:
        a, b = waiting.pop()
        if a in first.ends and b in then.ends:
            made.end((a, b), first.ends[a] + then.ends[b])
        for reads, middle, weight, a_next in from_state[a]:
            for writes, more, b_next in then.arcs.get((b, middle), ()):
                to = (a_next, b_next)
                made.arc((a, b), reads, writes, weight + more, to)
                if to not in seen:
                    seen.add(to)
                    waiting.append(to)
    return made


def best_output(machine: Transducer, letters: str) -> str | None:
    """Output of the heaviest path that reads ``letters``; ties go to the first in letter order."""
    paths = {machine.start: (0.0, "")}
    for letter in letters:
        following: dict[object, tuple[float, str]] = {}
        for state, (weight, written) in paths.items():
            for writes, more, to in machine.arcs.get((state, letter), ()):
                new = (weight + more, written + writes)
                old = following.get(to)
                if old is None or new[0] > old[0] or (new[0] == old[0] and new[1] < old[1]):
                    following[to] = new
        paths = following
    whole = [(-weight - machine.ends[s], written) for s, (weight, written) in paths.items() if s in machine.ends]
    return min(whole)[1] if whole else None

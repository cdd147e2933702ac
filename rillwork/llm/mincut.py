"""Minimum cuts of small graphs by blocking flows."""

from __future__ import annotations

EPS = 1e-9


def labels(costs: list[float], ties: list[tuple[int, int, float]]) -> list[bool]:
    """The cheapest labelling: True for each node on the source's side.

    A node with a negative cost hangs on the source with capacity -cost, one with a positive cost on the sink;
    ``ties`` (a, b, weight) are cut if a and b get different labels. Of several cheapest labellings it
    is the one with the most nodes on the source's side.
    """
    n = len(costs)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    edges: list[list[int]] = [[] for _ in range(n + 2)]

    def add(a, b, forth, back):
        edges[a].append(len(to))
        to.append(b)
        room.append(forth)
        edges[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, c in enumerate(costs):
        if c < 0:
            add(source, i, -c, 0.0)
        elif c > 0:
            add(i, sink, c, 0.0)
    for a, b, w in ties:
        add(a, b, w, w)

    while True:
        depth = [-1] * (n + 2)
        depth[source] = 0
        queue = [source]
        for a in queue:
            for e in edges[a]:
                if room[e] > EPS and depth[to[e]] < 0:
                    depth[to[e]] = depth[a] + 1
                    queue.append(to[e])
        if depth[sink] < 0:
            break
        place = [0] * (n + 2)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                cut = next(i for i, e in enumerate(path) if room[e] <= EPS)
                at = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while place[at] < len(edges[at]):
                e = edges[at][place[at]]
                if room[e] > EPS and depth[to[e]] == depth[at] + 1:
                    break
                place[at] += 1
            else:
                if not path:
                    break
                depth[at] = -1
                at = to[path.pop() ^ 1]
                continue
            path.append(e)
            at = to[e]
    # What cannot reach the sink any more.
    reach = [False] * (n + 2)
    reach[sink] = True
    queue = [sink]
    for a in queue:
        for e in edges[a]:
            if room[e ^ 1] > EPS and not reach[to[e]]:
                reach[to[e]] = True
                queue.append(to[e])
    return [not r for r in reach[:n]]

"""Named graphs of a session, and namespaces that lead to graph sources."""

from __future__ import annotations

from typing import Protocol

from pyspark import StorageLevel

from graphloom.errors import GraphError, GraphExistsError, GraphNotFoundError
from graphloom.model.graph import PropertyGraph

# The namespace of graphs stored by name only, and the graph that is always there.
SESSION_NAMESPACE = "session"
EMPTY_GRAPH = "emptyGraph"


class GraphSource(Protocol):
    """Where the graphs of a namespace come from."""

    def graph_names(self) -> list[str]: ...

    def graph(self, name: str) -> PropertyGraph: ...

    def store(self, name: str, graph: PropertyGraph, overwrite: bool = False) -> None: ...

    def delete(self, name: str) -> None: ...


class SessionGraphs:
    """Graphs held by name; their tables stay lazy."""

    def __init__(self, spark):
        self._graphs = {EMPTY_GRAPH: PropertyGraph.empty(spark)}

    def graph_names(self) -> list[str]:
        return sorted(self._graphs)

    def graph(self, name: str) -> PropertyGraph:
        if name not in self._graphs:
            raise GraphNotFoundError(name)
        return self._graphs[name]

    def store(self, name: str, graph: PropertyGraph, overwrite: bool = False) -> None:
        if name in self._graphs and not overwrite:
            raise GraphExistsError(name)
        self._graphs[name] = graph

    def delete(self, name: str) -> None:
        self._graphs.pop(name, None)


class CachedSource:
    """A source whose graphs are persisted on first use and released on delete."""

    def __init__(self, source: GraphSource, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
        self._source = source
        self._level = level
        self._cached: dict[str, PropertyGraph] = {}

    def graph_names(self) -> list[str]:
        return self._source.graph_names()

    def graph(self, name: str) -> PropertyGraph:
        if name not in self._cached:
            self._cached[name] = self._source.graph(name).persist(self._level)
        return self._cached[name]

    def store(self, name: str, graph: PropertyGraph, overwrite: bool = False) -> None:
        self._release(name)
        self._source.store(name, graph, overwrite)

    def delete(self, name: str) -> None:
        self._release(name)
        self._source.delete(name)

    def _release(self, name: str) -> None:
        if name in self._cached:
            self._cached.pop(name).unpersist()


class GraphCatalog:
    """`catalog.graph('ns.name')`; names without a registered namespace are session graphs."""

    def __init__(self, spark):
        self.spark = spark
        self._sources: dict[str, GraphSource] = {SESSION_NAMESPACE: SessionGraphs(spark)}

    @property
    def namespaces(self) -> list[str]:
        return sorted(self._sources)

    def register(self, namespace: str, source: GraphSource) -> None:
        if namespace in self._sources:
            raise GraphError(f"namespace '{namespace}' is taken")
        self._sources[namespace] = source

    def deregister(self, namespace: str) -> None:
        if namespace == SESSION_NAMESPACE:
            raise GraphError("the session namespace stays")
        self._sources.pop(namespace, None)

    def source(self, namespace: str) -> GraphSource:
        if namespace not in self._sources:
            raise GraphNotFoundError(f"no namespace '{namespace}'")
        return self._sources[namespace]

    def _resolve(self, name: str) -> tuple[GraphSource, str]:
        namespace, dot, rest = name.partition(".")
        if dot and namespace in self._sources:
            return self._sources[namespace], rest
        return self._sources[SESSION_NAMESPACE], name

    def graph(self, name: str) -> PropertyGraph:
        """The graph a query runs on. A name nobody knows is an error, not an empty result."""
        source, rest = self._resolve(name)
        return source.graph(rest)

    def graph_names(self) -> list[str]:
        return sorted(f"{ns}.{name}" for ns, source in self._sources.items() for name in source.graph_names())

    def store(self, name: str, graph: PropertyGraph, overwrite: bool = False) -> None:
        source, rest = self._resolve(name)
        source.store(rest, graph, overwrite)

    def drop(self, name: str) -> None:
        source, rest = self._resolve(name)
        source.delete(rest)

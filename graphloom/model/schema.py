"""What a graph is made of: label sets, relationship types, their properties and endpoints."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import types as T

from graphloom.errors import GraphSchemaError
from graphloom.model.types import common_type, parse_type_name, type_name

Labels = frozenset[str]
Properties = Mapping[str, T.DataType]

# Names and version in the stored JSON of a schema.
SCHEMA_VERSION = "1.0"
VERSION_KEY = "version"
NODES_KEY = "labelPropertyMap"
RELATIONSHIPS_KEY = "relTypePropertyMap"
LABELS_KEY = "labels"
TYPE_KEY = "relType"
PROPERTIES_KEY = "properties"
PATTERNS_KEY = "patterns"
NODE_KEYS_KEY = "nodeKeys"
REL_KEYS_KEY = "relKeys"


@dataclass(frozen=True)
class SchemaPattern:
    """One `(source)-[type]->(target)` shape present in the graph."""

    source: Labels
    rel_type: str
    target: Labels


def _merged(left: Properties, right: Properties, where: str) -> dict[str, T.DataType]:
    merged = dict(left)
    for key, data_type in right.items():
        joined = common_type(merged.get(key, data_type), data_type)
        if joined is None:
            raise GraphSchemaError(
                f"{where}: property '{key}' is {merged[key].simpleString()} and {data_type.simpleString()}"
            )
        merged[key] = joined
    return merged


@dataclass(frozen=True)
class GraphSchema:
    """Properties per label combination and per relationship type, plus keys and patterns."""

    node_properties: Mapping[Labels, Properties] = field(default_factory=dict)
    rel_properties: Mapping[str, Properties] = field(default_factory=dict)
    patterns: frozenset[SchemaPattern] = frozenset()
    node_keys: Mapping[str, frozenset[str]] = field(default_factory=dict)
    rel_keys: Mapping[str, frozenset[str]] = field(default_factory=dict)

    # -- building ---------------------------------------------------------------------------------

    def with_node(self, labels: Iterable[str], properties: Properties | None = None) -> GraphSchema:
        combo = frozenset(labels)
        nodes = dict(self.node_properties)
        nodes[combo] = _merged(nodes.get(combo, {}), properties or {}, f"node {sorted(combo)}")
        return self._replace(node_properties=nodes)

    def with_relationship(self, rel_type: str, properties: Properties | None = None) -> GraphSchema:
        rels = dict(self.rel_properties)
        rels[rel_type] = _merged(rels.get(rel_type, {}), properties or {}, f"relationship {rel_type}")
        return self._replace(rel_properties=rels)

    def with_pattern(self, source: Iterable[str], rel_type: str, target: Iterable[str]) -> GraphSchema:
        pattern = SchemaPattern(frozenset(source), rel_type, frozenset(target))
        return self._replace(patterns=self.patterns | {pattern})

    def with_node_key(self, label: str, key: Iterable[str]) -> GraphSchema:
        return self._replace(node_keys={**self.node_keys, label: frozenset(key)})

    def with_relationship_key(self, rel_type: str, key: Iterable[str]) -> GraphSchema:
        return self._replace(rel_keys={**self.rel_keys, rel_type: frozenset(key)})

    def without_properties(self, labels: Iterable[str]) -> GraphSchema:
        return self._replace(node_properties={**self.node_properties, frozenset(labels): {}})

    def __add__(self, other: GraphSchema) -> GraphSchema:
        merged = self
        for labels, properties in other.node_properties.items():
            merged = merged.with_node(labels, properties)
        for rel_type, properties in other.rel_properties.items():
            merged = merged.with_relationship(rel_type, properties)
        return merged._replace(
            patterns=merged.patterns | other.patterns,
            node_keys={**self.node_keys, **other.node_keys},
            rel_keys={**self.rel_keys, **other.rel_keys},
        )

    def _replace(self, **changes) -> GraphSchema:
        current = {name: getattr(self, name) for name in self.__dataclass_fields__}
        return GraphSchema(**{**current, **changes})

    # -- asking -----------------------------------------------------------------------------------

    @property
    def is_empty(self) -> bool:
        return not self.node_properties and not self.rel_properties

    @property
    def labels(self) -> set[str]:
        return {label for combo in self.node_properties for label in combo}

    @property
    def label_combinations(self) -> set[Labels]:
        return set(self.node_properties)

    @property
    def relationship_types(self) -> set[str]:
        return set(self.rel_properties)

    def combinations_for(self, labels: Iterable[str]) -> set[Labels]:
        """Label combinations that contain all the given labels."""
        wanted = frozenset(labels)
        return {combo for combo in self.node_properties if wanted <= combo}

    def implied_labels(self, labels: Iterable[str]) -> set[str]:
        """Labels every node that has the given labels also has."""
        combos = self.combinations_for(labels)
        return set(frozenset.intersection(*combos)) if combos else set()

    def node_property_keys(self, labels: Iterable[str]) -> dict[str, T.DataType]:
        """Properties of exactly this label combination."""
        return dict(self.node_properties.get(frozenset(labels), {}))

    def node_property_keys_for(self, labels: Iterable[str]) -> dict[str, T.DataType]:
        """Properties over all combinations that contain the labels."""
        merged: dict[str, T.DataType] = {}
        for combo in sorted(self.combinations_for(labels), key=sorted):
            merged = _merged(merged, self.node_properties[combo], f"nodes with {sorted(frozenset(labels))}")
        return merged

    def node_property_type(self, labels: Iterable[str], key: str) -> T.DataType | None:
        return self.node_property_keys_for(labels).get(key)

    def relationship_property_keys(self, rel_type: str) -> dict[str, T.DataType]:
        return dict(self.rel_properties.get(rel_type, {}))

    def relationship_property_keys_for(self, types: Iterable[str] = ()) -> dict[str, T.DataType]:
        """Properties over the given types; no types means all of them."""
        merged: dict[str, T.DataType] = {}
        for rel_type in sorted(set(types) or self.relationship_types):
            merged = _merged(merged, self.rel_properties.get(rel_type, {}), f"relationships {rel_type}")
        return merged

    def relationship_property_type(self, types: Iterable[str], key: str) -> T.DataType | None:
        return self.relationship_property_keys_for(types).get(key)

    def patterns_for(
        self, source: Iterable[str] = (), types: Iterable[str] = (), target: Iterable[str] = ()
    ) -> set[SchemaPattern]:
        source, types, target = frozenset(source), set(types), frozenset(target)
        return {
            p
            for p in self.patterns
            if source <= p.source and target <= p.target and (not types or p.rel_type in types)
        }

    def for_nodes(self, labels: Iterable[str]) -> GraphSchema:
        """The part of the schema nodes with these labels can have."""
        return GraphSchema(node_properties={c: self.node_properties[c] for c in self.combinations_for(labels)})

    def for_relationships(self, types: Iterable[str]) -> GraphSchema:
        wanted = set(types) or self.relationship_types
        return GraphSchema(rel_properties={t: p for t, p in self.rel_properties.items() if t in wanted})

    def check(self) -> GraphSchema:
        """Refuse properties that label combinations sharing a label store with clashing types."""
        for left, right in combinations(sorted(self.node_properties, key=sorted), 2):
            if left & right:
                _merged(
                    self.node_properties[left],
                    self.node_properties[right],
                    f"label combinations {sorted(left)} and {sorted(right)}",
                )
        return self

    # -- text -------------------------------------------------------------------------------------

    def pretty(self) -> str:
        lines = []
        for combo in sorted(self.node_properties, key=sorted):
            lines.append(f"(:{':'.join(sorted(combo))})")
            lines += [f"  {k}: {type_name(t)}" for k, t in sorted(self.node_properties[combo].items())]
        for rel_type in sorted(self.rel_properties):
            lines.append(f"[:{rel_type}]")
            lines += [f"  {k}: {type_name(t)}" for k, t in sorted(self.rel_properties[rel_type].items())]
        for p in sorted(self.patterns, key=lambda p: (p.rel_type, sorted(p.source), sorted(p.target))):
            lines.append(f"(:{':'.join(sorted(p.source))})-[:{p.rel_type}]->(:{':'.join(sorted(p.target))})")
        return "\n".join(lines)

    def to_dict(self) -> dict:
        def named(properties: Properties) -> dict[str, str]:
            return {k: type_name(t) for k, t in sorted(properties.items())}

        stored: dict = {
            VERSION_KEY: SCHEMA_VERSION,
            NODES_KEY: [
                {LABELS_KEY: sorted(combo), PROPERTIES_KEY: named(self.node_properties[combo])}
                for combo in sorted(self.node_properties, key=sorted)
            ],
            RELATIONSHIPS_KEY: [
                {TYPE_KEY: rel_type, PROPERTIES_KEY: named(self.rel_properties[rel_type])}
                for rel_type in sorted(self.rel_properties)
            ],
        }
        if self.patterns:
            stored[PATTERNS_KEY] = sorted(
                ([sorted(p.source), p.rel_type, sorted(p.target)] for p in self.patterns), key=json.dumps
            )
        if self.node_keys:
            stored[NODE_KEYS_KEY] = {k: sorted(v) for k, v in sorted(self.node_keys.items())}
        if self.rel_keys:
            stored[REL_KEYS_KEY] = {k: sorted(v) for k, v in sorted(self.rel_keys.items())}
        return stored

    def to_json(self) -> str:
        return json.dumps(self.to_dict(), indent=2)

    @classmethod
    def from_dict(cls, stored: dict) -> GraphSchema:
        schema = cls()
        for entry in stored.get(NODES_KEY, []):
            schema = schema.with_node(
                entry[LABELS_KEY], {k: parse_type_name(v) for k, v in entry[PROPERTIES_KEY].items()}
            )
        for entry in stored.get(RELATIONSHIPS_KEY, []):
            schema = schema.with_relationship(
                entry[TYPE_KEY], {k: parse_type_name(v) for k, v in entry[PROPERTIES_KEY].items()}
            )
        for source, rel_type, target in stored.get(PATTERNS_KEY, []):
            schema = schema.with_pattern(source, rel_type, target)
        for label, key in stored.get(NODE_KEYS_KEY, {}).items():
            schema = schema.with_node_key(label, key)
        for rel_type, key in stored.get(REL_KEYS_KEY, {}).items():
            schema = schema.with_relationship_key(rel_type, key)
        return schema

    @classmethod
    def from_json(cls, text: str) -> GraphSchema:
        return cls.from_dict(json.loads(text))

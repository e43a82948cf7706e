"""Errors raised by the graph layer."""


class GraphError(Exception):
    """Base class of every error raised here."""


class GraphTypeError(GraphError):
    """A column has a type the graph model has no place for."""


class GraphSchemaError(GraphError):
    """Tables contradict each other, or the schema they were declared with."""


class GraphNotFoundError(GraphError):
    """The catalog or source holds no graph under that name."""


class GraphExistsError(GraphError):
    """A graph is already stored under that name."""


class UnboundVariable(GraphSchemaError):
    """A pattern has no variable of that name."""

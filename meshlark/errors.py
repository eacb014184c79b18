"""Errors, raised when a plan is built or a snapshot is changed."""


class MeshError(Exception):
    """Base of all errors of this library."""


class UnresolvableTraversal(MeshError):
    """reason is one of unresolved_hop, unresolved_reached, unmapped_property, unsupported_predicate, empty_chain."""

    def __init__(self, reason: str, **context):
        super().__init__(f"{reason}: {context}")
        self.reason, self.context = reason, context


class GeoDimensionMismatch(MeshError):
    """A 3D geometry where a 2D one is needed, or the other way round."""


class Unsupported3DGeometry(MeshError):
    """Lines and areas are stored in 2D only."""


class GuardViolation(MeshError):
    """A node that guards protect was to be deleted."""


class UpsertConflict(MeshError):
    """Several nodes have the identity of an upsert."""


class MissingNode(MeshError):
    """An edge names a node that does not exist."""


class EdgeConflict(MeshError):
    """New edges contradict each other: an exclusive end has several."""


class SaveConflict(MeshError):
    """Another writer has saved a version since the snapshot was opened."""


class Rollback(MeshError):
    """Ends a transaction on purpose; reason says why."""

    def __init__(self, reason: object = None):
        super().__init__(str(reason))
        self.reason = reason

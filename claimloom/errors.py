"""Error raised when data breaks the contract it is processed under."""


class ContractError(ValueError):
    """A source, key or result does not satisfy its contract."""

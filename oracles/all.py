from oracles.models import MODELS
from oracles.views import VIEWS


def all_oracles() -> dict[str, str]:
    from oracles.operators import OPERATORS

    out = dict(MODELS)
    out.update(VIEWS)
    out.update(OPERATORS)
    return out

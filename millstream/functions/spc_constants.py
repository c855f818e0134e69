"""Control chart coefficients per subgroup size."""

from __future__ import annotations

import math
from dataclasses import dataclass

SIGMAS = 3.0
TABLE_LIMIT = 26  # sizes from here on use the c4 approximation; range factors are zero

# d2, d3 and c4 for subgroup sizes 1, 2, 3, ...
D2 = [1, 1.128, 1.693, 2.059, 2.326, 2.534, 2.704, 2.847, 2.97, 3.078, 3.173, 3.258, 3.336, 3.407, 3.472, 3.532, 3.588,
      3.64, 3.689, 3.735, 3.778, 3.819, 3.858, 3.895, 3.931]
D3 = [0.82, 0.8525, 0.8884, 0.8794, 0.8641, 0.848, 0.8332, 0.8198, 0.8078, 0.7971, 0.7873, 0.7785, 0.7704, 0.763,
      0.7562, 0.7499, 0.7441, 0.7386, 0.7335, 0.7287, 0.7242, 0.7199, 0.7159, 0.7121, 0.7084]
C4 = [0, 0.797885, 0.886227, 0.921318, 0.939986, 0.951533, 0.959369, 0.96503, 0.969311, 0.972659, 0.97535, 0.977559,
      0.979406, 0.980971, 0.982316, 0.983484, 0.984506, 0.98541, 0.986214, 0.986934, 0.987583, 0.98817, 0.988705,
      0.989193, 0.98964]


@dataclass(frozen=True)
class Coefficients:
    n: int
    d2: float
    a2: float
    a3: float
    b3: float
    b4: float
    d3_limit: float
    d4_limit: float


def spc_coefficients(n: int) -> Coefficients:
    """A2, A3, B3, B4, D3, D4 for subgroups of `n` (at least 2)."""
    tabled = n < TABLE_LIMIT
    c4 = C4[n - 1] if tabled else 4.0 * (n - 1) / (4.0 * n - 3)
    d2 = D2[n - 1] if tabled else 0.0
    spread = SIGMAS / c4 * math.sqrt(1 - c4 * c4)
    ratio = SIGMAS * D3[n - 1] / d2 if tabled else 0.0
    return Coefficients(
        n=n,
        d2=d2,
        a2=SIGMAS / (d2 * math.sqrt(n)) if tabled else 0.0,
        a3=SIGMAS / (c4 * math.sqrt(n)),
        b3=max(0.0, 1 - spread),
        b4=1 + spread,
        d3_limit=max(0.0, 1 - ratio) if tabled else 0.0,
        d4_limit=1 + ratio if tabled else 0.0,
    )

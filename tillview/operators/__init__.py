"""DataFrame-in, DataFrame-out operators. None of them runs an action unless
its docstring says so, and none reads the clock: dates come in as ``as_of``."""

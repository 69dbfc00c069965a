from ticklake.sources.tables import (  # noqa: F401
    read_table, read_trades, messages, trades, trades_dup, messages_bad,
    trades_rt, arrivals, instruments, wire_lines, log_lines,
)

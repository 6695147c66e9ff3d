"""Column-level helpers: pandas-compatible windows, blocked EMA, global ordered scans."""

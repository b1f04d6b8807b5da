from relkit.functions.exprs import charge, money, month_start, net_price, year_of

__all__ = ["charge", "money", "month_start", "net_price", "year_of"]

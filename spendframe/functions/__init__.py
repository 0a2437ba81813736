from spendframe.functions.scalar import (band, change, money, money_text, ratio, short_money,
                                         week_of_month, weekday_monday1)

__all__ = ["band", "change", "money", "money_text", "ratio", "short_money",
           "week_of_month", "weekday_monday1"]

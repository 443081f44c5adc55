"""The sample of one device's polls that the golden values of FIXTURES.md (G2) are for."""

# Each poll's time after the first in ms, humidity, temperature
# (a 32-bit number) and how often it was served.
FIRST_MS = 1648607463508
POLLS = [
    (0, 42, 30.1, 1), (2395, 42, 30.1, 1), (4851, 42, 30.2, 1), (7495, 41, 30.2, 2), (9968, 42, 30.2, 1),
    (11959, 42, 30.1, 1), (15365, 42, 30.2, 2), (18594, 42, 30.2, 1), (21497, 42, 30.2, 2), (25602, 41, 30.2, 2),
    (29392, 42, 30.2, 2), (33280, 42, 30.2, 2), (36520, 42, 30.2, 1), (39412, 42, 30.3, 1), (41976, 42, 30.2, 2),
    (45476, 42, 30.3, 1), (48446, 42, 30.3, 2), (52484, 42, 30.3, 2), (55401, 42, 30.3, 1), (58047, 42, 30.3, 1),
    (59894, 41, 30.3, 2), (64001, 41, 30.3, 1), (66288, 41, 30.3, 2), (69799, 41, 30.3, 1), (72054, 41, 30.3, 1),
    (75477, 41, 30.3, 2), (77817, 42, 30.3, 1), (80372, 41, 30.3, 1), (82288, 41, 30.4, 1), (85714, 41, 30.4, 2),
    (89603, 41, 30.4, 2), (93441, 41, 30.4, 2), (97280, 41, 30.4, 1), (99000, 41, 30.4, 1), (102399, 41, 30.5, 2),
    (105638, 41, 30.5, 2), (110077, 41, 30.4, 2), (113915, 41, 30.5, 2), (117765, 41, 30.4, 1), (120132, 41, 30.4, 2),
    (123552, 41, 30.4, 1), (126435, 41, 30.5, 2),
]


def sample_lines() -> list[str]:
    import numpy as np

    out = []
    for after, humidity, temperature, times in POLLS:
        for _ in range(times):
            out += ["dev-1,sensor_data,1648606918090,AQQA", f"dev-1,humidity_data,{FIRST_MS + after},{float(humidity)}",
                    f"dev-1,temperature_data,{FIRST_MS + after},{float(np.float32(temperature))}"]
    return out

"""Fixed domain values: class order, control limits, geometry, costs and dimensions."""

# ---- fixed values -----------------------------------------------------------------
CLASSES = [
    "none", "Center", "Donut", "Edge-Loc", "Edge-Ring",
    "Loc", "Near-full", "Random", "Scratch",
]
UNKNOWN = "unknown"
SPLITS = ["train", "val", "test"]

# Random image steps of training, in order.
TRAIN_AUGMENTATION = {
    "Rotate": {"limit": 20, "border_mode": 0, "p": 0.5},
    "HorizontalFlip": {"p": 0.5},
    "VerticalFlip": {"p": 0.5},
    "GaussNoise": {"var_limit": (0.001, 0.005), "p": 0.3},
    "Blur": {"blur_limit": 3, "p": 0.2},
    "RandomBrightnessContrast": {"brightness_limit": 0.05, "contrast_limit": 0.05, "p": 0.2},
    "CoarseDropout": {"min_holes": 1, "max_holes": 4, "min_height": 4, "max_height": 8, "min_width": 4, "max_width": 8, "fill_value": 0.0, "p": 0.3},
}

PARAMS = [
    "cmp_pressure", "polish_time", "slurry_ph", "annealing_temp", "temp_gradient",
    "etch_depth", "vacuum_pressure", "pr_thickness_cv", "particle_count",
]

# Control limits (lower, upper). vacuum_pressure has none.
SPC_LIMITS = {
    "cmp_pressure": (80.0, 120.0),
    "polish_time": (25.0, 45.0),
    "slurry_ph": (5.5, 7.5),
    "annealing_temp": (1050.0, 1150.0),
    "temp_gradient": (0.0, 2.0),
    "etch_depth": (450.0, 550.0),
    "pr_thickness_cv": (0.0, 5.0),
    "particle_count": (0.0, 10.0),
}
CPK_EPS = 1e-9
ROLLING_ROWS = 25

# Operator-panel settings: min, max, normal_min, normal_max, mean, std, step.
DISPLAY_PARAMS = {
    "cmp_pressure": (60.0, 140.0, 80.0, 120.0, 100.0, 10.0, 1.0),
    "polish_time": (10.0, 80.0, 20.0, 60.0, 40.0, 7.0, 1.0),
    "slurry_ph": (3.0, 10.0, 4.0, 8.0, 6.5, 0.5, 0.1),
    "annealing_temp": (1000.0, 1200.0, 1050.0, 1150.0, 1100.0, 25.0, 1.0),
    "temp_gradient": (0.0, 5.0, 0.0, 2.0, 1.0, 0.3, 0.05),
    "etch_depth": (430.0, 570.0, 450.0, 550.0, 500.0, 25.0, 1.0),
    "vacuum_pressure": (0.5, 3.0, 0.5, 2.0, 1.0, 0.15, 0.05),
    "pr_thickness_cv": (0.3, 5.0, 0.0, 2.0, 1.8, 0.7, 0.1),
    "particle_count": (0.0, 30.0, 0.0, 10.0, 5.0, 3.0, 0.5),
}

# Panel coefficients: class -> {parameter: r}.
DISPLAY_CORRELATIONS = {
    "Center": {"annealing_temp": 0.5265},
    "Donut": {"pr_thickness_cv": 0.6083, "etch_depth": 0.35},
    "Edge-Loc": {"polish_time": -0.554, "cmp_pressure": 0.40, "slurry_ph": -0.35},
    "Edge-Ring": {"temp_gradient": 0.664},
    "Loc": {"vacuum_pressure": 0.5337, "particle_count": 0.40},
    "Near-full": {"particle_count": 0.5311, "annealing_temp": 0.40, "temp_gradient": 0.35},
    "Random": {"particle_count": 0.3989},
    "Scratch": {"polish_time": 0.4439},
}

# Panel stages and the defect classes each can cause.
STAGE_DEFECTS = {
    "wafer-prep": ["Center"],
    "thermal": ["Center", "Edge-Ring", "Near-full"],
    "litho": ["Donut", "Loc"],
    "etch": ["Donut", "Edge-Loc"],
    "cmp": ["Edge-Loc", "Scratch"],
    "pvd": ["Loc", "Edge-Loc"],
    "implant": ["Loc"],
    "clean": ["Edge-Ring", "Random"],
    "handle": ["Scratch", "Random"],
    "inspect": [],
}

# Process stage relevance per class: 0 unrelated, 1 related, 2 main cause.
PROCESS_STAGES = [
    "Crystal Growth", "Wafer Annealing", "Thermal Oxidation/CVD", "Lithography", "Etch",
    "CMP", "PVD/Deposition", "Ion Implantation", "Cleaning", "Wafer Handling",
]
STAGE_RELEVANCE = {
    "Center": [2, 2, 1, 0, 0, 0, 0, 0, 0, 0],
    "Donut": [0, 0, 0, 2, 2, 1, 0, 0, 0, 0],
    "Edge-Loc": [0, 0, 0, 0, 1, 2, 2, 0, 0, 0],
    "Edge-Ring": [0, 1, 2, 0, 0, 0, 0, 0, 2, 0],
    "Loc": [0, 0, 0, 1, 1, 0, 2, 2, 0, 0],
    "Near-full": [2, 2, 1, 1, 1, 1, 1, 1, 2, 0],
    "Random": [0, 0, 0, 0, 0, 0, 0, 0, 1, 2],
    "Scratch": [0, 0, 0, 0, 0, 1, 0, 0, 0, 2],
}

# Class -> (severity level, severity score, yield impact, estimated ROI percent).
CLASS_META = {
    "none": ("None", 0, 0.0, None),
    "Center": ("Critical", 5, 0.15, 800.0),
    "Donut": ("High", 4, 0.10, 650.0),
    "Edge-Loc": ("High", 4, 0.08, 1200.0),
    "Edge-Ring": ("High", 4, 0.09, 950.0),
    "Loc": ("Medium", 3, 0.05, 500.0),
    "Near-full": ("Critical", 5, 0.95, 3000.0),
    "Random": ("Medium", 3, 0.04, 400.0),
    "Scratch": ("Medium", 3, 0.03, 300.0),
}
SEVERITY_INDEX = {"Critical": 0, "High": 1, "Medium": 2, "Low": 2, "None": 3}
SEVERITY_CONFIDENCE = {"Critical": 1.0, "High": 0.70, "Medium": 0.40, "Low": 0.40, "None": 0.0}

# Search bounds and adjustment cost per unit, in dollars.
PARAM_BOUNDS = {
    "cmp_pressure": (80.0, 130.0),
    "polish_time": (18.0, 65.0),
    "slurry_ph": (4.0, 8.5),
    "annealing_temp": (1050.0, 1190.0),
    "temp_gradient": (0.2, 2.8),
    "etch_depth": (410.0, 600.0),
    "vacuum_pressure": (5e-7, 1.8e-6),
    "pr_thickness_cv": (0.8, 4.2),
    "particle_count": (1.0, 18.0),
}
PARAM_COST = {
    "cmp_pressure": 400.0,
    "polish_time": 800.0,
    "slurry_ph": 2500.0,
    "annealing_temp": 3000.0,
    "temp_gradient": 6000.0,
    "etch_depth": 250.0,
    "vacuum_pressure": 5e7,
    "pr_thickness_cv": 7000.0,
    "particle_count": 9000.0,
}
SCENARIO_PAIRS = [
    ("Edge-Loc", "cmp_pressure"), ("Center", "annealing_temp"), ("Edge-Ring", "temp_gradient"),
    ("Donut", "pr_thickness_cv"), ("Random", "particle_count"), ("Scratch", "cmp_pressure"),
]
ROI_CLASSES = ["Edge-Loc", "Center", "Edge-Ring", "Near-full", "Donut"]
MONTHLY_WAFERS = 50_000
WAFER_VALUE = 500.0
MONTHLY_REVENUE = MONTHLY_WAFERS * WAFER_VALUE

# Alert level -> particle count and pressure above which it holds, worst first.
ALERT_LEVELS = {"CRITICAL": (15.0, 125.0), "WARNING": (10.0, 115.0)}

RISK_THRESHOLD = 0.3
SIGNIFICANCE = 0.05
# ---- end of fixed values ----------------------------------------------------------

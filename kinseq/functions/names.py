"""Dimension data: names and index tables that results depend on."""

from __future__ import annotations

# Names and order of the body landmarks.
BODY = ["nose", "neck", "rightEye", "leftEye", "rightEar", "leftEar", "rightShoulder", "leftShoulder", "rightElbow", "leftElbow", "rightWrist", "leftWrist"]
# Names and order of the hand landmarks.
HAND = ["wrist", "indexTip", "indexDIP", "indexPIP", "indexMCP", "middleTip", "middleDIP", "middlePIP", "middleMCP", "ringTip", "ringDIP", "ringPIP", "ringMCP", "littleTip", "littleDIP", "littlePIP", "littleMCP", "thumbTip", "thumbIP", "thumbMP", "thumbCMC"]
# Hand points in the order in which they are taken from an observation.
HAND_POINTS = ["WRIST", "INDEX_FINGER_TIP", "INDEX_FINGER_DIP", "INDEX_FINGER_PIP", "INDEX_FINGER_MCP", "MIDDLE_FINGER_TIP", "MIDDLE_FINGER_DIP", "MIDDLE_FINGER_PIP", "MIDDLE_FINGER_MCP", "RING_FINGER_TIP", "RING_FINGER_DIP", "RING_FINGER_PIP", "RING_FINGER_MCP", "PINKY_DIP", "PINKY_TIP", "PINKY_PIP", "PINKY_MCP", "THUMB_TIP", "THUMB_IP", "THUMB_MCP", "THUMB_CMC"]
# The face points that are kept.
FACE_POINTS = ["70", "105", "336", "334", "33", "133", "159", "145", "362", "263", "386", "374", "61", "291", "0", "17", "13", "14", "37", "267"]
# An arm from its root outwards.
ARM = ["neck", "{side}Shoulder", "{side}Elbow", "{side}Wrist"]
# Whole-body indices of the three joint layouts.
JOINTS = {
    27: [0, 5, 6, 7, 8, 9, 10, 91, 95, 96, 99, 100, 103, 104, 107, 108, 111, 112, 116, 117, 120, 121, 124, 125, 128, 129, 132],
    31: [*range(11), 91, 95, 96, 99, 100, 103, 104, 107, 108, 111, 112, 116, 117, 120, 121, 124, 125, 128, 129, 132],
    59: [*range(17), *range(91, 133)],
}
# Names of the whole-body indices 0-16 and of a hand's 21 points in index order.
BODY_POINTS = ["NOSE", "LEFT_EYE", "RIGHT_EYE", "LEFT_EAR", "RIGHT_EAR", "LEFT_SHOULDER", "RIGHT_SHOULDER", "LEFT_ELBOW", "RIGHT_ELBOW", "LEFT_WRIST", "RIGHT_WRIST", "LEFT_HIP", "RIGHT_HIP", "LEFT_KNEE", "RIGHT_KNEE", "LEFT_ANKLE", "RIGHT_ANKLE"]
HAND_INDEX = ["WRIST", "THUMB_CMC", "THUMB_MCP", "THUMB_IP", "THUMB_TIP", "INDEX_FINGER_MCP", "INDEX_FINGER_PIP", "INDEX_FINGER_DIP", "INDEX_FINGER_TIP", "MIDDLE_FINGER_MCP", "MIDDLE_FINGER_PIP", "MIDDLE_FINGER_DIP", "MIDDLE_FINGER_TIP", "RING_FINGER_MCP", "RING_FINGER_PIP", "RING_FINGER_DIP", "RING_FINGER_TIP", "PINKY_MCP", "PINKY_PIP", "PINKY_DIP", "PINKY_TIP"]
# Parent and child of each bone of the 27-joint layout, counted from 5.
BONES_FROM_5 = [(5, 6), (5, 7), (6, 8), (8, 10), (7, 9), (9, 11), (12, 13), (12, 14), (12, 16), (12, 18), (12, 20), (14, 15), (16, 17), (18, 19), (20, 21), (22, 23), (22, 24), (22, 26), (22, 28), (22, 30), (24, 25), (26, 27), (28, 29), (30, 31), (10, 12), (11, 22)]
BONES = [(a - 5, b - 5) for a, b in BONES_FROM_5]
# Signers of the fixed split, by role; three change their role with the camera.
VAL_SIGNERS, TEST_SIGNERS, SHARED_SIGNERS = ["007"], ["024"], ["009"]
BY_CAMERA = {"020": ("1", "2", "3"), "014": ("2", "3", "1"), "015": ("3", "1", "2")}
# Extensions of video files.
VIDEO_EXTENSIONS = (".mp4", ".avi", ".mov", ".mkv")


def hand_labels(order: str = "interleaved") -> list[str]:
    """The 42 hand labels: ``id_0, id_1`` interleaved, or all of hand 0 and then of hand 1."""
    if order == "interleaved":
        return [f"{name}_{side}" for name in HAND for side in (0, 1)]
    return [f"{name}_{side}" for side in (0, 1) for name in HAND]


def landmarks(face: bool = False) -> list[str]:
    return BODY + [f"face_{i}" for i in range(20)] * face + hand_labels()


def observation_points(face: bool = False) -> list[tuple[str, str]]:
    """(component, point) in the order in which joint selection emits them."""
    body = [("POSE_LANDMARKS", "".join("_" + c if c.isupper() else c.upper() for c in name)) for name in BODY]
    out = body + [("FACE_LANDMARKS", p) for p in FACE_POINTS] * face
    return out + [(f"{side}_HAND_LANDMARKS", p) for side in ("LEFT", "RIGHT") for p in HAND_POINTS]


def whole_body_point(index: int) -> tuple[str, str]:
    """(component, point) of a whole-body index."""
    if index < 17:
        return "POSE_LANDMARKS", BODY_POINTS[index]
    side, at = ("LEFT", index - 91) if index < 112 else ("RIGHT", index - 112)
    return f"{side}_HAND_LANDMARKS", HAND_INDEX[at]

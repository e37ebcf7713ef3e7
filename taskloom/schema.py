"""Spark types of the records: project graphs, mutation specs, solver output, training triplets."""

MODE = "struct<mode_id:int,duration:int,renewable_demands:map<string,int>,nonrenewable_demands:map<string,int>>"
ACTIVITY = f"struct<id:int,duration:int,demands:map<string,int>,modes:array<{MODE}>>"
WINDOW = "struct<start:int,end:int,delta:int>"
RESOURCE = f"struct<id:string,capacity:int,type:string,downtime:array<{WINDOW}>>"
EDGE = "struct<i:int,j:int,relation:string,lag_min:int,lag_max:int>"
OBJECTIVE = "struct<type:string,task_weights:map<string,double>,task_deadlines:map<string,int>>"
SPEC = (
    "struct<op:string,resource:string,severity:string,position:string,delta:int,t_start:int,t_end:int,i:int,j:int,relation:string,lag_severity:string,"
    "has_max_lag:boolean,max_lag_severity:string,lag_min:int,lag_max:int,activity_id:int,mode_id:int,duration_delta:int,demand_deltas:map<string,int>,"
    "nonrenewable_deltas:map<string,int>,remove_mode_ids:array<int>,duration:int,renewable_demands:map<string,int>,nonrenewable_demands:map<string,int>,"
    "obj_type:string,task_weights:map<string,double>,task_deadlines:map<string,int>>"
)
GRAPH = (
    "struct<instance_id:string,source:string,type:string,difficulty:string,question_type:string,RF:double,RS:double,split:string,structural_hash:string,"
    f"critical_path_length:int,activities:array<{ACTIVITY}>,resources:array<{RESOURCE}>,precedences:array<{EDGE}>,objective:{OBJECTIVE},mutations_applied:array<{SPEC}>>"
)
SOLUTION = "struct<status:string,objective:double,schedule:map<string,int>,best_bound:double>"
